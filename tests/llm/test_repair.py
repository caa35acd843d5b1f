import hashlib
import itertools
import random
import re
import zlib

import pytest

from fleetplan.llm import repair as R
from tests.llm import fixtures as X

SCHEMA = "conv_id long, turn long, role string, text string, audit string, dropped string"
ROWS = "xsuaoSUAO"


def exhaustive(rows):
    """Every choice of edits, with up to two insertions in each gap."""
    inserts = [("", 0, ""), ("I", 3, "u"), ("I", 3, "a"), ("II", 6, "ua"), ("II", 6, "au")]
    options = []
    for r in rows:
        more = 3 if r.isupper() else 0
        kept = [] if r == "x" else [("K", more, r.lower()), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        options.append([("D", 4, ""), *kept])
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for chosen in itertools.product(*options):
            steps = [gaps[0], *itertools.chain.from_iterable(zip(chosen, gaps[1:], strict=True))]
            audit, cost, roles = "".join(s[0] for s in steps), sum(s[1] for s in steps), "".join(s[2] for s in steps)
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_columns(rows):
    """Least (cost, audit) from each node to the end, column by column from the last."""
    none = (R.FAR, "")
    ahead = [none] * R.STATES
    for at in range(len(rows), -1, -1):
        here = [(0, "") if at == len(rows) and q in R.FINAL else none for q in range(R.STATES)]
        for _ in range(R.STATES):
            for q in range(R.STATES):
                for letter, cost, node in R._steps(rows, at * R.STATES + q):
                    to, state = divmod(node, R.STATES)
                    rest = here[state] if to == at else ahead[state]
                    if rest[0] < R.FAR:
                        here[q] = min(here[q], (rest[0] + cost, letter + rest[1]))
        ahead = here
    return ahead[R.EMPTY]


def test_short_rows_against_all_edits():
    rng = random.Random(1)
    cases = [c for n in range(3) for c in itertools.product(ROWS, repeat=n)]
    cases += [tuple(rng.choices(ROWS, k=3)) for _ in range(40)]
    for rows in map("".join, cases):
        assert R.cheapest(rows) == exhaustive(rows), rows


def test_longer_rows_against_columns():
    rng = random.Random(2)
    for _ in range(1500):
        rows = "".join(rng.choices(ROWS + "uauaua", k=rng.randint(0, 40)))
        assert R.cheapest(rows) == by_columns(rows), rows


def test_very_long_rows():
    rng = random.Random(3)
    rows = "".join(rng.choices("uauaxsUA", k=3000))
    assert R.cheapest(rows) == by_columns(rows)
    rows = "".join(rng.choices("uauaxsUA", k=30_000))
    assert sum(c != "I" for c in R.cheapest(rows)[1]) == len(rows)


def test_well_formed_rows_stay():
    for rows in ("", "ua", "sua", "suaua"):
        assert R.cheapest(rows) == (0, "K" * len(rows))
    assert R.cheapest("s") == (4, "D") and R.cheapest("u") == (3, "KI") and R.cheapest("a") == (3, "IK")


# ---------------------------------------------------------------- tables
def _strip(text):
    return text.strip(" \t\n\x0b\x0c\r")


def plain(conversations):
    """The contract over Python lists: conv_id -> its row."""
    groups = {}
    for conv_id, turn, role, text in conversations:
        rows = groups.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
        rows += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = {}
    for conv_id, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, seen, counts = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            body = _strip(text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit = by_columns(codes)
        lines, left = [], list(rows)
        for edit in audit:
            role, text = ("", "") if edit == "I" else left.pop(0)[1:]
            if edit in "IR":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{text}")
        out[conv_id] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, conversations):
    extra = [(*c, "x", "y") for c in conversations]
    got = R.repairs(spark.createDataFrame(extra, SCHEMA).repartition(5)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain(conversations)
    assert len(got) == len(plain(conversations))


def test_given_conversations(spark):
    table = spark.read.parquet(f"{X.SF_LARGER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r)[1:] for r in R.repairs(table).collect()} == plain(rows)


def test_random_conversations(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "aide"]
    texts = ["Yes.", "No", " \n", "", None, "Why?\r\n", "x! ", "é", "a:b\nc."]
    conversations = []
    for conv_id in [*range(150), None, -5]:
        for turn in rng.sample([None, *range(-3, 9), 1 << 60], rng.randint(1, 9)):
            conversations += [(conv_id, turn, rng.choice(roles), rng.choice(texts))] * rng.choice((1, 1, 1, 2))
    check(spark, conversations)


def test_ties_and_null_turns(spark):
    rng = random.Random(5)
    rows = [(i, None, rng.choice(("user", "assistant")), f"t{rng.randint(0, 3)}.") for i in range(30) for _ in range(4)]
    check(spark, rows)


def test_all_dropped_and_empty(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi.")]
    check(spark, rows)
    (row,) = R.repairs(spark.createDataFrame([(*rows[0], "", "")], SCHEMA)).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert R.repairs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_long_conversation(spark):
    rng = random.Random(6)
    check(spark, [(1, t, rng.choice(("user", "assistant")), f"{t}" + rng.choice((".", ""))) for t in range(6000)])


@pytest.mark.parametrize("batch", [1, 3])
def test_repaired_rows(spark, monkeypatch, batch):
    monkeypatch.setattr(R, "BATCH", batch)
    table = spark.read.parquet(f"{X.SF}/conversations.parquet")
    rows = R.damaged(table)
    found = R.audits(rows).cache()
    lines = {}
    for r in R.repaired(rows, found).orderBy("conv_id", "place").collect():
        assert r.place == len(lines.setdefault(r.conv_id, [])) + 1
        lines[r.conv_id].append(r)
    for r in found.collect():
        mine = lines.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in mine))
        assert [x.edit for x in mine] == [e for e in r.audit if e != "D"]
    found.unpersist()
