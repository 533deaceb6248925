import random
import re
from collections import Counter, defaultdict

from tests.llm.conftest import SMALL, WORDS, prose
from tidemark.llm import catalog, line_templates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LT = line_templates


def tokens(line):
    return tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line))


def fit(lines, leaf_of):
    """line -> leaf of the lines that keep to the template of their leaf."""
    leaves = defaultdict(list)
    for t in lines:
        leaves[leaf_of(t)].append(t)
    found = {}
    for leaf, members in leaves.items():
        fixed = []
        for column in zip(*members, strict=True):
            token, n = Counter(column).most_common(1)[0]
            fixed.append(token if 2 * n > len(members) else None)
        n_fixed = sum(f is not None for f in fixed)
        if len(members) < 2 or n_fixed < LT.SIMILARITY * len(fixed):
            continue
        fits = [t for t in members
                if sum(f == w for f, w in zip(fixed, t, strict=True)) >= LT.SIMILARITY * n_fixed]
        if len(fits) > 1:
            found |= {t: leaf for t in fits}
    return found


def brute(rows):
    """(id, text) -> dropped line numbers or None; rows without an id come last."""
    holders = defaultdict(list)
    for k, text in rows:
        for t in {tokens(line) for line in (text or "").split("\n")}:
            if len(t) >= LT.MIN_TOKENS:
                holders[t].append((k is None, k, text))
    group, rest = {}, list(holders)
    for depth in LT.DEPTHS:
        leaf = (lambda d: lambda t: (d, len(t), t[:d]))(depth)
        shared = Counter((len(t), t[:LT.DEPTHS[0]]) for t in holders)
        found = fit([t for t in rest if shared[len(t), t[:LT.DEPTHS[0]]] > 1], leaf)
        group |= found
        rest = [t for t in rest if t not in found]
    members = defaultdict(list)
    for t in holders:
        members[group.get(t, t)].append(t)
    keeper = {}
    for lines in members.values():
        owners = [h for t in lines for h in holders[t]]
        if len(owners) >= (LT.LONG_DOCS if len(lines[0]) >= LT.LONG_TOKENS else LT.SHORT_DOCS):
            keeper |= dict.fromkeys(lines, min(owners, key=lambda h: (h[0], h[1] or 0)))
    out = {}
    for k, text in rows:
        drop = [i for i, line in enumerate((text or "").split("\n"))
                if keeper.get(tokens(line), (k is None, k, text)) != (k is None, k, text)]
        out[k, text] = drop or None
    return out


def check(rows, out):
    want = brute(rows)
    assert len(out) == len(rows)
    for r, original in out:
        drop = want[r.doc_id, original]
        assert r.dropped_lines == drop, (r.doc_id, r.dropped_lines, drop)
        lines = (original or "").split("\n")
        kept = "\n".join(line for i, line in enumerate(lines) if i not in (drop or []))
        assert r.text == (original if drop is None else kept)


def test_query_against_brute_force(spark, small_texts):
    out = catalog.op10_line_templates(spark, SMALL).collect()
    check(list(small_texts.items()), [(r, small_texts[r.doc_id]) for r in out])
    assert sum(r.n_dropped for r in out) > 20
    assert all(r.n_dropped == len(r.dropped_lines or []) for r in out)


def test_templates_with_variable_fields(spark):
    r = random.Random(3)
    rows = []
    for i in range(60):
        lines = [prose(1000 + i, r.randint(12, 60)) for _ in range(3)]
        lines.insert(r.randint(0, 3), f"copyright {1990 + i} by the authors of {r.choice(WORDS)} "
                                      f"all rights are reserved here {i}")
        if i % 2:
            lines.append("the cookie notice of this site says hello to everyone reading "
                         + r.choice(WORDS))
        if i % 7 == 0:
            lines.append("ok go on")
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {x.doc_id: x for x in LT.dedup_lines(docs).collect()}
    check(rows, [(out[k], t) for k, t in rows])
    assert "copyright" in out[0].text and "cookie" in out[1].text
    assert not any("copyright" in out[i].text for i in range(1, 60))
    assert not any("cookie" in out[i].text for i in range(3, 60))
    assert all("ok go on" in out[i].text for i in range(0, 60, 7))


def test_unrelated_lines_stay(spark):
    rows = [(i, prose(i, 200).replace("the of", "\n")) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(x.dropped_lines is None for x in LT.dedup_lines(docs).collect())


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    cleaned = LT.dedup_lines(odd_docs)
    assert set(cleaned.columns) == {*odd_docs.columns, "dropped_lines"}
    by_id = dict(rows)
    check(rows, [(r, by_id[r.doc_id]) for r in cleaned.collect()])
    assert LT.dedup_lines(no_docs).count() == 0


def test_a_minority_in_a_leaf_is_a_template(spark):
    """Lines of one leaf: 40 and 12 of two templates beside 60 unlike ones."""
    r = random.Random(8)

    def word():
        return "".join(r.choice("abcdefghij") for _ in range(9))

    kinds = {i: "notice" if i < 40 else "offer" if i < 52 else "other" for i in range(112)}
    tail = {"notice": lambda: f"the shop in {word()} is closed on every sunday and",
            "offer": lambda: f"all members get {word()} for half of what it cost",
            "other": lambda: " ".join(word() for _ in range(10))}
    rows = [(i, f"dear reader of this {tail[k]()}") for i, k in kinds.items()]
    out = {x.doc_id: x.dropped_lines for x in LT.dedup_lines(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    first = {"notice": 0, "offer": 40}
    assert out == {i: [0] if i != first.get(k, i) else None for i, k in kinds.items()}


def test_number_rows_are_compared_as_they_are(spark):
    """Table rows of unrelated documents are not equal; a row that recurs as it is goes."""
    r = random.Random(9)
    rows = [(i, " ".join(str(r.randint(100, 999)) for _ in range(9))) for i in range(30)]
    rows += [(30 + i, "total " + rows[i][1]) for i in range(20)] + [(99, rows[4][1])]
    out = {x.doc_id: x.dropped_lines for x in LT.dedup_lines(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {k: [0] if k == 99 else None for k, _ in rows}


def test_an_instance_keeps_to_the_whole_width(spark):
    """20 tokens with 14 constants: a line with 10 of them is half of another text."""
    r = random.Random(10)

    def line(n):
        words = "to all who read this page we say that it was made by hand".split()[:n]
        return " ".join(words + ["".join(r.choice("abcdefghij") for _ in range(9))
                                 for _ in range(20 - n)])

    rows = [(i, line(14)) for i in range(8)] + [(8, line(10))]
    out = {x.doc_id: x.dropped_lines for x in LT.dedup_lines(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {i: [0] if 0 < i < 8 else None for i in range(9)}


def test_lines_of_few_tokens_but_many_characters(spark):
    """A Chinese line is one token; a Latin line of three needs five documents."""
    chinese, short = "版权所有未经书面许可不得转载本网站的任何内容", "版权"
    latin = "Nutzungsbedingungen Datenschutzerklärung Impressum"
    rows = [(i, "\n".join([f"eigener Text {i}", short, *[chinese] * (i < 2), *[latin] * (1 < i < 8)]))
            for i in range(10)] + [(10, "Haftungsausschluss Barrierefreiheit"),
                                   (11, "Haftungsausschluss Barrierefreiheit")]
    out = {x.doc_id: x.dropped_lines for x in LT.dedup_lines(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {i: [2] if i == 1 or 2 < i < 8 else None for i in range(12)}
