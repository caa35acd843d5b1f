"""Chat formatting as prefix trees: shared initial turns are emitted once.

Conversations that begin with the same turns share nodes of a tree. A tree is
written depth first as one token sequence: each node's tokens once, with the
position of its first token on the path from the root (position ids go on from
there) and the intervals of its ancestors in the sequence, which its tokens may
attend to besides the earlier ones of the node. A node is a maximal stretch of
turns that the same conversations pass through.

Turns are marked by control strings. Inside texts these are escaped reversibly,
so a text can't end its turn, and the roles and texts can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import public_tokenizers
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetplan.llm.common import ordinary_ids, rank_encoding, stored

RANKS = "byte_bpe_50k.tiktoken"

# Fixed strings of the template: what stands before and after a text, by role.
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
OTHER = ("<<ROLE>>", "<</ROLE>>\n", "\n<</TURN>>")
CONTROL = ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>", "<</TURN>>")
TRAINED = "assistant"

_ESCAPE = re.compile("|".join(map(re.escape, [*CONTROL, "\\"])))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    "|".join([*(f"{re.escape(a)}(?P<{r}>.*?){re.escape(b)}" for r, (a, b) in MARKS.items()), f"{OTHER[0]}(?P<role>.*?){OTHER[1]}(?P<text>.*?){OTHER[2]}"]),
    re.DOTALL,
)


def escape(text: str) -> str:
    """A backslash after the first character of each control string, and each
    backslash doubled: no control string is left."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text of a turn, the escaped text, what follows."""
    before, after = MARKS.get(role) or (OTHER[0] + escape(role) + OTHER[1], OTHER[2])
    return before, escape(text), after


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn begins at {at}")
        found = m.groupdict()
        role = next((r for r in MARKS if found[r] is not None), None)
        turns.append((role, unescape(found[role])) if role else (unescape(found["role"]), unescape(found["text"])))
        at = m.end()
    return turns


def chain(turns: Sequence[tuple[str, str]]) -> list[str]:
    """For each turn, a 128-bit digest of all turns up to it, as hex."""
    state, out = xxhash.xxh3_128(), []
    for role, text in turns:
        for x in (role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")):
            state.update(len(x).to_bytes(8, "little") + x)
        out.append(state.hexdigest())
    return out


def _turn_rows(conversations: DataFrame) -> DataFrame:
    """A row for each turn: ``conv`` (the id as text, '' for null), ``conv_id``,
    ``at`` (from 0), ``n_turns``, ``role``, ``text`` and ``prefix``, the digest
    of the conversation so far. One conversation has to fit a task, as the
    training example that it is."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = whole.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "rows.role", "rows.text")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, roles, texts in zip(batch["conv"], batch["role"], batch["text"], strict=True):
                turns = list(zip(roles, texts, strict=True))
                out += [(conv, i, len(turns), *turn, key) for i, (turn, key) in enumerate(zip(turns, chain(turns), strict=True))]
            yield pd.DataFrame(out, columns=["conv", "at", "n_turns", "role", "text", "prefix"])

    return whole.mapInPandas(number, "conv string, at int, n_turns long, role string, text string, prefix string")


def _paths(turns: DataFrame) -> DataFrame:
    """A row for each conversation: its ``heads``, the first turns of the nodes
    on its path (``at``, ``prefix``, ``mine``: whether this conversation is the
    one that emits the node) and its ``turns`` that it may have to emit."""
    shared = stored(turns.groupBy("prefix").agg(F.count("*").alias("n"), F.min("conv").alias("first")), "chat-prefixes")
    near = turns.join(shared, "prefix")
    mine = F.col("conv") == F.col("first")
    kept = F.struct("at", "prefix", "n", mine.alias("mine"), F.when(mine, F.col("role")).alias("role"), F.when(mine, F.col("text")).alias("text"))
    whole = near.groupBy("conv").agg(F.first("n_turns").alias("n_turns"), F.sort_array(F.collect_list(kept)).alias("turns"))
    # A new node begins where fewer conversations go on than came here.
    starts = F.filter("turns", lambda x, i: (i == 0) | (x["n"] != F.get(F.col("turns"), i - 1)["n"]))
    return whole.withColumn("heads", F.transform(starts, lambda x: F.struct(x["at"], x["prefix"], x["mine"])))


def _nodes(paths: DataFrame, ranks: str) -> DataFrame:
    """Every node once: ``tree``, ``node``, ``path`` (nodes from the root to it,
    end to end, so that text order is depth-first order), ``above`` (the same as
    a list, without itself), ``ids`` and ``loss`` (token intervals)."""
    ends = F.transform("heads", lambda x, i: F.coalesce(F.get(F.col("heads"), i + 1)["at"], F.size("turns")))
    row = F.transform(
        F.arrays_zip("heads", ends.alias("ends")),
        lambda x, i: F.struct(
            x["heads"]["mine"].alias("mine"),
            x["heads"]["prefix"].alias("node"),
            F.transform(F.slice("heads", F.lit(1), i), lambda h: h["prefix"]).alias("above"),
            F.slice("turns", x["heads"]["at"] + 1, x["ends"] - x["heads"]["at"]).alias("turns"),
        ),
    )
    own = paths.select(F.explode(F.filter(row, lambda x: x["mine"])).alias("x")).select("x.node", "x.above", "x.turns.role", "x.turns.text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = rank_encoding(ranks)
        for batch in batches:
            all_ids, all_loss = [], []
            for roles, texts in zip(batch["role"], batch["text"], strict=True):
                ids, loss = [], []
                for role, text in zip(roles, texts, strict=True):
                    # Marks and text are encoded apart, so that the mask ends with a token.
                    before, body, after = (ordinary_ids(encoding, x) for x in parts(role, text))
                    start = len(ids) + len(before)
                    ids += [*before, *body, *after]
                    if role == TRAINED and body:
                        loss.append({"start": start, "end": start + len(body)})
                all_ids.append(ids)
                all_loss.append(loss)
            yield pd.DataFrame({"node": batch["node"], "above": batch["above"], "ids": all_ids, "loss": all_loss})

    out = own.mapInPandas(encode, "node string, above array<string>, ids array<int>, loss array<struct<start:int,end:int>>")
    tree = F.coalesce(F.get("above", F.lit(0)), F.col("node"))
    return out.select(tree.alias("tree"), "node", F.concat(F.array_join("above", ""), F.col("node")).alias("path"), "above", "ids", "loss")


def _with_offsets(nodes: DataFrame) -> DataFrame:
    """Nodes with ``start`` and ``end`` in their tree's sequence: running sums in
    depth-first order. A range partitioning splits even a single tree; partition
    totals carry the sums over from one partition to the next."""
    ranged = nodes.repartitionByRange("tree", "path").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "chat-ranged")
    light = ranged.select("tree", "path", "part", F.size("ids").cast("long").alias("size"))
    sums = light.groupBy("tree", "part").agg(F.sum("size").alias("size"))
    # One row for each tree and partition that it reaches.
    carry = sums.alias("a").join(sums.select("tree", F.col("part").alias("p"), F.col("size").alias("s")).alias("b"), "tree")
    carry = carry.where("p < part").groupBy("tree", "part").agg(F.sum("s").alias("carry"))
    inside = F.sum("size").over(Window.partitionBy("tree", "part").orderBy("path"))
    placed = light.withColumn("inside", inside).join(carry, ["tree", "part"], "left").select("path", (F.coalesce("carry", F.lit(0)) + F.col("inside")).alias("end"))
    return ranged.drop("part").join(placed, "path").withColumn("start", F.col("end") - F.size("ids"))


def format_trees(conversations: DataFrame, ranks: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The formatted trees, and where each conversation ends in them.

    Trees: ``tree``, ``node``, ``parent``, ``start``, ``end`` (in the tree's
    sequence), ``position`` (of the first token), ``attends`` (the ancestors'
    intervals, in order), ``ids`` and ``loss`` (intervals within ``ids`` that
    hold assistant texts). Members: ``conv_id``, ``n_turns``, ``tree`` and
    ``node``, the last one of the conversation.

    Turns go by (turn, role, text); repeated rows are repeated turns. A null
    text or role counts as empty, a null id is one conversation of its own, and
    any role but user, assistant and system is written out. Other columns are not
    read; an empty table gives two empty ones.
    """
    turns = stored(_turn_rows(conversations), "chat-turns")
    paths = stored(_paths(turns), "chat-paths")
    nodes = stored(_with_offsets(_nodes(paths, ranks or public_tokenizers.path(RANKS))), "chat-nodes")
    spans = nodes.select(F.col("node").alias("ancestor"), F.struct("start", "end").alias("span"))
    above = nodes.select("node", F.explode("above").alias("ancestor")).join(spans, "ancestor")
    above = above.groupBy("node").agg(F.sort_array(F.collect_list("span")).alias("attends"))  # as many as the path has nodes
    trees = nodes.join(above, "node", "left").withColumn("attends", F.coalesce("attends", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    position = F.aggregate("attends", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    parent = F.get("above", F.size("above") - 1)
    trees = stored(trees.select("tree", "node", parent.alias("parent"), "start", "end", position.alias("position"), "attends", "ids", "loss"), "chat-trees")
    last = F.element_at("heads", -1)["prefix"]
    conv_id = F.when(F.col("conv") != "", F.col("conv").cast("long"))
    members = paths.select(conv_id.alias("conv_id"), "n_turns", F.element_at("heads", 1)["prefix"].alias("tree"), last.alias("node"))
    return trees, members


def read_back(trees: DataFrame, members: DataFrame, ranks: str | None = None) -> DataFrame:
    """Each conversation's digests, read from the formatted trees: the tokens a
    conversation's last node attends to and its own, decoded and split into turns.
    Conversations that end in the same node are read once."""
    path = ranks or public_tokenizers.path(RANKS)
    wanted = members.select("tree", "node").distinct()
    every = F.concat("attends", F.array(F.struct("start", "end")))
    spans = trees.join(wanted.select("node"), "node", "left_semi").select("tree", F.col("node").alias("last"), F.explode(every).alias("span"))
    spans = stored(spans.select("tree", "last", "span.start"), "chat-spans")
    # On a conversation's own path, a node's tokens begin at its position.
    moved = F.transform("loss", lambda x: F.struct((x["start"] + F.col("position")).alias("start"), (x["end"] + F.col("position")).alias("end")))
    held = spans.join(trees.select("tree", "start", "ids", moved.alias("loss")), ["tree", "start"])
    lists = held.groupBy("last").agg(F.sort_array(F.collect_list(F.struct("start", "ids", "loss"))).alias("held"))
    lists = lists.select("last", F.flatten("held.ids").alias("ids"), F.flatten("held.loss").alias("loss")).select("last", "ids", "loss.start", "loss.end")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = rank_encoding(path)
        for batch in batches:
            out = []
            for last, ids, starts, ends in zip(batch["last"], batch["ids"], batch["start"], batch["end"], strict=True):
                decode = lambda part: encoding.decode_bytes(part.tolist()).decode("utf-8", "surrogatepass")
                text = decode(ids)
                trained = "".join(unescape(decode(ids[a:b])) for a, b in zip(starts, ends, strict=True))
                turns = "".join(f"{r}\n{t}\n" for r, t in read_turns(text))
                out.append((last, _sha(turns), len(trained), _sha(trained), len(text)))
            yield pd.DataFrame(out, columns=["node", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = "node string, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    digests = stored(lists.mapInPandas(read, schema), "chat-digests")
    return members.join(digests, "node").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """All conversations, formatted and read back."""
    return read_back(*format_trees(conversations))
