import random
import re
from collections import Counter

from tests.llm.conftest import SMALL, prose
from tidemark.llm import catalog, secret_forest

PATTERN = re.compile(secret_forest.CANDIDATE.replace("{12,}+", "{12,}"))


def expected(rows):
    """(id, number, finding, before, after) of rows (id, text)."""
    out = []
    for k, text in rows:
        end, spans = 0, [m.span() for m in PATTERN.finditer(text or "")]
        for i, (a, b) in enumerate(spans):
            nxt = spans[i + 1][0] if i + 1 < len(spans) else len(text)
            out.append((k, i, text[a:b], text[end:a][-secret_forest.CONTEXT:],
                        text[b:nxt][:secret_forest.CONTEXT]))
            end = b
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.at, r.finding, r.before, r.after) for r in df.collect()), key=str)


def test_query_finds_every_candidate(spark, small_texts):
    out = catalog.op4_secret_forest(spark, SMALL)
    assert found(out) == expected(small_texts.items())


def test_query_tells_keys_from_numbers(spark):
    out = catalog.op4_secret_forest(spark, "/root/testdata/sf0.1").collect()
    keys = [r.secret for r in out if re.search(r"token = \"$", r.before)]
    numbers = [r.secret for r in out if r.finding.isdigit()]
    assert len(keys) > 100 and all(keys)
    assert len(numbers) > 100 and not any(numbers)


def hex_key(r, n=32):
    return "".join(r.choice("0123456789abcdef") for _ in range(n - 1)) + "7"


def test_labelled_findings_remove_false_positives(spark):
    """A review calls random keys secrets and build ids of the same length harmless when
    they follow 'build'; the forest carries that over to other texts."""
    r = random.Random(5)
    review, rows, truth = [], [], {}
    for i in range(400):
        secret = i % 2
        key = hex_key(r) if i % 3 else "river-window-garden-" + str(r.randint(10, 99))
        word = "login" if secret and i % 3 else "build"
        label = int(word == "login")
        if i < 300:
            review.append((key, f"{prose(i, 5)} {word} ", " next", "log", label))
        else:
            rows.append((i, f"{prose(i, 30)} {word} {key} {prose(i + 1, 30)}", "log"))
            truth[i] = bool(label)
    findings = spark.createDataFrame(
        review, "finding string, before string, after string, path string, label int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {x.doc_id: x.secret for x in secret_forest.scan(docs, findings).collect()}
    assert out == truth


def test_odd_rows(odd_docs, no_docs, spark):
    docs = odd_docs.unionByName(odd_docs.selectExpr(*[
        "'password=abc123def456ghi, twice password=abc123def456ghi 4111111111111111' AS text"
        if c == "text" else c for c in odd_docs.columns]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = secret_forest.scan(docs)
    assert found(out) == expected(rows)
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert secret_forest.scan(no_docs).count() == 0
    none = spark.createDataFrame(
        [], "finding string, before string, after string, path string, label int")
    assert {r.score for r in secret_forest.scan(docs, none).collect()} == {0.5}


def test_pair_table_is_bounded_and_normalised(spark):
    words = spark.createDataFrame([("abc", 5), ("abd", 3)], "word string, n bigint")
    table = {r.pair: r.log_p for r in secret_forest.pair_table(words).collect()}
    assert set(table) == {"_a", "ab", "bc", "bd", "c_", "d_"}
    assert table["bc"] > table["bd"]


def test_no_python_in_the_plan(odd_docs):
    plan = secret_forest.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert Counter(plan.split())["CartesianProduct"] == 0
