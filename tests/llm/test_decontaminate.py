import random

from sparkgate.llm import decontaminate as D
from tests.conftest import SF_SMALL


def table(item, text):
    """Lowest distance of the item to any part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    low = min(row)
    return low, row.index(low)


def test_bit_parallel_distance():
    rnd = random.Random(5)
    for _ in range(300):
        item = "".join(rnd.choice("abé ") for _ in range(rnd.randrange(1, 90)))
        text = "".join(rnd.choice("abé ") for _ in range(rnd.randrange(0, 120)))
        assert D.distance(D.letters(item), len(item), text) == table(item, text)


def edited(rnd, item, n):
    s = list(item)
    for _ in range(n):
        i = rnd.randrange(len(s))
        kind = rnd.randrange(3)
        if kind == 0:
            s[i] = rnd.choice("xyz")
        elif kind == 1:
            del s[i]
        else:
            s.insert(i, rnd.choice("xyz"))
    return "".join(s)


def test_every_occurrence_within_the_budget_is_found(spark, monkeypatch):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    items = [(k, " ".join(word() for _ in range(rnd.randrange(2, 30)))) for k in range(12)]
    items += [(50, None), (51, "  "), (52, "ab"), (None, "no id at all here"), (0, items[0][1])]
    rows = [(1, None), (2, ""), (None, items[3][1]), (3, "q " * 50_000)]
    for i in range(60):
        text = " ".join(word() for _ in range(40))
        if i % 2:
            item = items[i % 12][1]
            text += " " + edited(rnd, item.upper(), rnd.randrange(0, len(item) // 8 + 1)) + "\n\t " + word()
        rows.append((10 + i, text))
    rows += rows[5:7]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_errors int")
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    want = []
    for doc, text in rows:
        for item, said in items:
            if said and said.strip():
                n, end = table(D.normal(said), D.normal(text))
                if n <= D.ERROR_RATE * len(D.normal(said)):
                    want.append(str((doc, item, n, end)))
    for block in (4_000_000, 300):
        monkeypatch.setattr(D, "BLOCK_CHARS", block)
        got = [str((r.doc_id, r.item_id, r.n_errors, r.end)) for r in D.hits(docs, bench).collect()]
        assert sorted(got) == sorted(want)
        kept = D.clean(docs, bench)
        assert kept.columns == docs.columns
        dirty = {w.split(",")[0][1:] for w in want}
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if str(d) not in dirty)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.hits(docs.limit(0), bench).collect() == [] and D.hits(docs, bench.limit(0)).collect() == []
    assert D.clean(docs, bench.limit(0)).count() == 1 and D.clean(docs, bench).count() == 0


def test_query_finds_every_whole_item(spark):
    from sparkgate.llm.queries import op2_decontaminate
    docs = {r.doc_id: D.normal(r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    bench = {r.item_id: D.normal(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.n_errors for r in op2_decontaminate(spark, SF_SMALL).collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    assert whole and {k for k, n in got.items() if n == 0} == whole
    for (d, i), n in got.items():
        assert table(bench[i], docs[d])[0] == n
