"""Source divergence and line dedup against plain Python, their SQL, and odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import divergence, line_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p long, h long, mark string, shard long, n_lines string, other string, value string"
BOILER = "  This line stands on every page of the site, whatever the page says \t"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 9) for r in rows], SCHEMA)


def rows_like_sql(spark, query, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    df = query(spark, SF)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got and got == sorted((tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()), key=repr)


def test_as_sql(spark):
    rows_like_sql(spark, divergence.op11_divergence, divergence.SQL)
    rows_like_sql(spark, line_dedup.op12_line_dedup, line_dedup.SQL)


def plain_audit(rows, min_docs, top):
    docs, n = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = [w.translate({b: b + 32 for b in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        n[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang, source in n:
        kept = {t for t, d in docs[lang].items() if d >= min_docs}
        whole = sum((c for (g, _), c in n.items() if g == lang), Counter())
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept}
        mine, q = price(n[lang, source]), price(whole)
        pairs = [(s, sum(abs(mine[t] - o) for t, o in price(c).items())) for (g, s), c in n.items() if g == lang and s != source]
        terms = [(t, mine[t] - q[t]) for t in kept if n[lang, source][t] and mine[t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(lang, source, part, i, v, r) for r, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def test_divergence(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["Apfel", "BIRNE", "straße", "ÄÖ", "don't", "x1y", "☃", "naïve", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(i, " ".join(rnd.choices(words, [1 / (k + 1) for k in range(len(words))], k=rnd.randint(0, 30))), rnd.choice(["de", "en", None, ""]), rnd.choice(["a", "b", "ß", "c", None])) for i in range(300)]
    rows += [(None, None, None, None), (1, "", "fr", "only"), (1, "", "fr", "empty"), (2, "apfel " * 60_000, "de", "a"), *[(3, "tie Tie TIE", "xx", s) for s in "abc" * 2]]
    df = frame(spark, rows)
    for least, top in ((5, 4), (1, 50), (10_000, 3)):
        assert sorted(map(tuple, divergence.audit(df, min_docs=least, top=top).collect())) == plain_audit(rows, least, top)
    assert divergence.audit(frame(spark, [])).count() == 0
    # held counts are handed on in parts
    groups = [("de", "a", " ".join(f"wort{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)))]
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD_TERMS", 100)
    batch = pa.record_batch([pa.array([c] * 3) for c in ("de", "a", groups[0][2])], names=["lang", "source", "text"])
    given = list(divergence._count([batch]))
    assert len(given) == 3 and sum(sum(b.column(3).to_pylist()) for b in given) == 900


def plain_lines(rows, chars=40, least=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({b: b + 32 for b in range(65, 91)})
    found = defaultdict(list)
    for i, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            found[k].append(-1 if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(k := key(x)) < chars or len(found[k]) < least or max(found[k]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines(spark, monkeypatch):
    rnd = random.Random(7)
    common = [f"{'ünï' if k % 3 else 'uni'} common line number {k} that several pages of one site repeat" for k in range(60)]
    edge = ["ü" * 39, "ü" * 40, "x" * 39, "x" * 40, "X" * 40 + "\r", " " * 50, "", BOILER, BOILER.strip().upper()]
    rows = [(i, "\n".join(rnd.choices([*common, *edge, f"a line that only page {i} has, and no other page at all"], k=rnd.randint(0, 12))), None, None) for i in range(200)]
    rows += [(None, None, None, None), (None, BOILER, None, None), (7, BOILER + "\n" + BOILER, None, None), (199, BOILER, None, None), (199, BOILER, None, None), (3, "word " * 60_000 + "\n" + BOILER, None, None), (4, "\n", None, None)]
    df = frame(spark, rows)
    want = plain_lines(rows)
    got = line_dedup.drop_lines(df)
    assert got.columns == [c for c in df.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    seen = lambda d: sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in d.collect()), key=repr)
    assert seen(got) == want and sum(r[2] for r in want) > 100
    assert any(r.text is None for r in got.collect())
    # beyond the lines that are sent to all tasks, lines probe the arrays of their shard
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 8)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 20)
    for limit in (0, 3, 20):
        assert seen(line_dedup.drop_lines(df, index_lines=limit)) == want
    assert line_dedup.drop_lines(frame(spark, [])).count() == 0
    # lines that only rows without an id have
    nulls = [(None, BOILER, None, None)] * 6
    assert seen(line_dedup.drop_lines(frame(spark, nulls))) == plain_lines(nulls)


def test_minimal_perfect_hash():
    rnd = np.random.default_rng(3)
    keys = np.unique(rnd.integers(-(1 << 63), (1 << 63) - 1, 50_000))
    rnd.shuffle(keys)
    members, others = keys[:40_000], keys[40_000:]
    fp = members * 7 + 1
    shards, rows = 9, []
    deal = line_dedup.shard_of(members, shards)
    for s in rnd.permutation(shards):
        h = members[deal == s]
        sizes, bits, place = line_dedup.build(h.view(np.uint64))
        assert sorted(place) == list(range(len(h)))  # minimal and perfect
        order = np.argsort(place)
        rows.append({"shard": s, "lines": len(h), "sizes": sizes, "bits": np.packbits(np.concatenate(bits)).tobytes(), "fp": fp[deal == s][order].tobytes(),
                     "n": np.full(len(h), 6, np.uint16).tobytes(), "keepers": h[order].tobytes()})
    index = line_dedup.Index(shards, rows)
    at = index.find(members, fp)
    assert sorted(at) == list(range(len(members))) and (index.keeper[at] == members).all()
    assert (index.find(others, others * 7 + 1) == -1).all() and (index.find(members, fp + 1) == -1).all()
    assert len(index.bits) * 8 < 4 * len(members)
    assert (line_dedup.Index(4, []).find(members, fp) == -1).all()
    with pytest.raises(ValueError):
        line_dedup.build(np.zeros(2, np.uint64))


def test_query_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in line_dedup.drop_lines(docs.select("doc_id", "text")).collect()}
    got = line_dedup.op12_line_dedup(spark, SF).select("doc_id", F.col("kept_sha256")).collect()
    assert {r.doc_id: hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got} == {r.doc_id: r.kept_sha256 for r in got}
