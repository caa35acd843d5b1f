import re
from collections import Counter

from fleetplan.llm import rules as R
from tests.llm import fixtures as X


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), base)


TEXTS = [
    "", None, " \n\t\x0b\x0c\r ", "a b c a b c a b c", "one\n\none\n \none two\n  one two", "x " * 100, "#$ <b>|*&%> " * 20,
    "née 𝒳𝒴 ß\x1c\x85\xa0 x", X.prose(400), X.prose(60) + "\n" + X.prose(60), X.prose(30_000), "w" * 200_000, "THE AND OF " + X.prose(200).upper(),
    "a b c d a b c e a b c", "the " + X.prose(100) + " the and of",
]


def test_counts_match_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in R.verdicts(X.documents(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i][:6] == brute(t), t and t[:60]
        assert not (got[i][5] and got[i][6])
    assert got[None][0] == 0 and R.verdicts(X.empty(spark)).count() == 0


def test_columns_pass_and_failed_rules_are_named(spark):
    docs = X.documents(spark, TEXTS).withColumnRenamed("found", "rule_words")
    out = R.count_measures(docs, into="counts")
    assert out.columns == [*docs.columns, "counts"]
    named = {r.doc_id: r.failed for r in R.apply_rules(out.select("doc_id", "counts.*")).collect()}
    assert named[0] == ["too_few_words"] and "repeated_words" in named[5] and "capitals" in named[12]


def test_one_projection_without_shuffle_or_python(spark):
    plan = R.verdicts(spark.read.parquet(f"{X.SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_labels(spark):
    """Good documents pass the ratio rules; junk that passes the base fails them."""
    docs = spark.read.parquet(f"{X.SF_LARGER}/documents.parquet")
    rows = R.verdicts(docs).join(spark.read.parquet(f"{X.SF_LARGER}/labels.parquet"), "doc_id").where("NOT base_failed").toPandas()
    assert rows[rows.quality == 1].kept.all() and not rows[rows.quality == 0].kept.any()
