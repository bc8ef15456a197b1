"""Lexical search, collocations and repeated windows against brute force, on
small tables with the edge cases of their docstrings."""
import glob
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import bitfilter, collocations, lexical_search, substring_dedup

DOCS = "doc_id bigint, text string, lang string, source string, key int, row int, n int, shard int, tid int, item int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def docs(spark, texts, langs=None, ids=None):
    """A documents table whose extra columns clash with internal names."""
    ids = range(len(texts)) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, g, "s", 1, 2, 3, 4, 5, 6) for i, t, g in zip(ids, texts, langs)], DOCS)


# ---- bounded filter ----

def test_filter_misses_no_key(spark):
    keys = spark.range(5000).selectExpr("id * 7919 - 12345678 as key")
    filt = bitfilter.build(keys, 5000)
    inside = np.arange(5000) * 7919 - 12345678
    assert filt.hits(inside).all()
    assert filt.hits(inside + 1).mean() < 0.01 and not filt.hits(np.zeros(0, np.int64)).size
    full = bitfilter.build(keys, 5000, max_bits=bitfilter.MIN_BITS)  # fills up, still misses none
    assert full.hits(inside).all()
    assert not bitfilter.build(keys.where("key = 0"), 0).hits(inside).any()


# ---- repeated windows ----

def brute_repeats(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeats(spark, texts, window, ids=None):
    rows = substring_dedup.drop_repeats(docs(spark, texts, ids=ids), window=window).collect()
    for r in rows:
        if r.kept is not None:
            assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    return sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def expected(texts, window, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return sorted((str(i), *r) for i, r in zip(ids, brute_repeats(texts, window)))


def planted(seed, n=40):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(200)]
    text = lambda k: [rnd.choice(vocab) for _ in range(k)]
    passages = [text(rnd.randint(8, 90)) for _ in range(4)]
    out = []
    for _ in range(n):
        t = text(rnd.randint(0, 150))
        for _ in range(rnd.randint(0, 2)):
            p, at = rnd.choice(passages), rnd.randint(0, len(t))
            a = rnd.randint(0, len(p) - 1)
            t[at:at] = p[a:rnd.randint(a, len(p))]
        out.append(rnd.choice([" ", "\n", "\t "]).join(t))
    near = out[3].split()
    near[len(near) // 2:len(near) // 2 + 1] = ["changed"]
    return out + [out[1], out[1].replace(" ", "\n"), " ".join(near)]


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 12), (4, 6)])
def test_repeats_equal_brute_force(spark, seed, window):
    texts = planted(seed)
    assert repeats(spark, texts, window) == expected(texts, window)


def test_repeats_of_odd_texts(spark):
    texts = [None, "", " \t\n ", "one", " ".join(["same"] * 90), " ".join(["same"] * 34), " ".join(["same"] * 35),
             " ".join(["a"] * 20 + ["b"] * 25), "x " + " ".join(["a"] * 25 + ["b"] * 15 + ["c"] * 9),
             " ".join(f"{'ab'[i % 2]}" for i in range(120)), " ".join(f"{'ab'[i % 2]}" for i in range(41)) + " tail",
             " ".join(f"{'abc'[i % 3]}" for i in range(70)), LONG, "é" * 9 + " " + LONG[:900], "  \u0085  "]
    assert repeats(spark, texts, 35) == expected(texts, 35)


def test_repeats_with_null_and_repeated_ids(spark):
    texts = planted(5, 12) + planted(5, 4)
    ids = [None, 1, 1, None, 2, 3, 3] + list(range(10, 10 + len(texts) - 7))
    assert repeats(spark, texts, 35, ids) == expected(texts, 35, ids)
    assert repeats(spark, [], 35) == []


def test_equal_windows_take_equal_anchors():
    rnd = random.Random(7)
    words = [rnd.choice("ab") if rnd.random() < 0.5 else f"v{rnd.randint(0, 30)}" for _ in range(400)]
    p = substring_dedup._Parsed([" ".join(words).encode(), "\t".join(words[37:300]).encode()], 20, 3)
    where = {}
    for s, n, lo, hi in p.rows.tolist():
        for i in range(s, s + n):
            where[i] = (lo - i, hi - i)
    first = int(p.first[1])
    assert all(where[first + i] == where[1 + 37 + i] for i in range(263 - 20 + 1))


def test_repeats_across_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        texts = planted(9, 20)
        assert repeats(spark, texts, 35) == expected(texts, 35)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


# ---- lexical search ----

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_search(texts, items, k, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    tf = [Counter(TERM.findall(lower(t))) for t in texts]
    n = [sum(c.values()) for c in tf]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in enumerate(tf):
            if not n[i]:
                continue
            m = 100 - 50 + 50 * n[i] * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(TERM.findall(lower(text))) if c[t])
            if s > 0:
                scores.append((-s, ids[i] is None, ids[i] if ids[i] is not None else 0))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def search(spark, texts, items, k, ids=None, stages=4):
    q = spark.createDataFrame(items, "item_id bigint, text string")
    got = lexical_search.ranked(docs(spark, texts, ids=ids), q, k, stages=stages).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"t{int(rnd.paretovariate(0.6))}" for _ in range(3000)]
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("k,stages", [(5, 4), (50, 2), (3, 1)])
def test_search_equals_brute_force(spark, monkeypatch, k, stages):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 37)
    texts = corpus(1, 400) + ["T1 t1, T2!"] * 120
    items = [(i, t) for i, t in enumerate(corpus(2, 12))] + [(90, texts[7]), (91, "t1 t2")]
    assert search(spark, texts, items, k, stages=stages) == brute_search(texts, items, k)


def test_search_of_odd_rows(spark):
    texts = [None, "", " .,; ", "Straße STRASSE straße", "ÄPFEL äpfel", "a-b_c 1.5", LONG, "日本語 テキスト", "tie", "tie", "tie"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, None, 9, 9]
    items = [(1, None), (2, ""), (3, "?!"), (4, "nowhere"), (5, "tie Straße"), (6, "ÄPFEL 1 5 b w5x5 日本語"), (6, "tie")]
    assert search(spark, texts, items, 4, ids) == brute_search(texts, items, 4, ids)
    assert search(spark, [], items, 4) == [] and search(spark, texts, [], 4) == []
    assert search(spark, [None, ""], items, 4) == []


def test_items_in_blocks_and_bundles(spark, monkeypatch):
    texts = corpus(3, 150)
    items = [(i, t) for i, t in enumerate(corpus(4, 23))]
    want = brute_search(texts, items, 6)
    monkeypatch.setattr(lexical_search, "BUNDLE", 4)
    assert search(spark, texts, items, 6) == want
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 60)
    assert search(spark, texts, items, 6) == want


def test_bucket_floors_hold_their_scores():
    scores = np.array([1, 2, 3, 17, 1000, 333_333, 2_600_000_001, 7 * 10**12])
    for s, b in zip(scores.tolist(), lexical_search.bucket(scores).tolist()):
        assert s * 0.98 - 1 < lexical_search.bucket_floor(b) <= s


# ---- collocations ----

def brute_collocations(rows, min_count=10, share=50, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                f.update((lang, *ws[i:i + k]) for i in range(len(ws) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    drop = {p[:1] + part for p, a in cand.items() if len(p) == 4 for part in (p[1:3], p[2:4])
            if 100 * a >= share * f[p[:1] + part]}
    out = []
    for lang in n:
        found = []
        for p, a in cand.items():
            if p[0] == lang and p not in drop:
                cuts = []
                for k in range(1, len(p) - 1):
                    left, right = f[(lang, *p[1:1 + k])], f[(lang, *p[1 + k:])]
                    cuts.append((1_000_000 * a * a // (left * right), k, left, right))
                s, _, left, right = min(cuts)
                found.append((-s, -a, " ".join(p[1:]).encode(), left, right))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def found(spark, rows, **kw):
    df = docs(spark, [t for _, t in rows], [g for g, _ in rows])
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score)
                  for r in collocations.collocations(df, **kw).collect())


def phrases(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{int(rnd.paretovariate(0.8))}" for _ in range(300)]
    rows = []
    for _ in range(n):
        ws = [rnd.choice(vocab) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 2)):
            ws[rnd.randint(0, len(ws)):0] = rnd.choice([["New", "york", "CITY"], ["à", "la", "carte"], ["ab", "ab", "ab"]])
        rows.append((rnd.choice(["en", "fr", None]), rnd.choice([" ", "  ", "\t", " . ", ", "]).join(ws)))
    return rows


@pytest.mark.parametrize("kw", [{}, {"dictionary": 12}, {"dictionary": 0}, {"min_count": 3, "top": 7}])
def test_collocations_equal_brute_force(spark, kw):
    rows = phrases(1, 400)
    want = brute_collocations(rows, **{k: v for k, v in kw.items() if k != "dictionary"})
    assert want and found(spark, rows, **kw) == want


def test_collocations_in_many_ranges_and_shards(spark, monkeypatch):
    rows = phrases(2, 300)
    want = brute_collocations(rows, top=4)
    for name, value in (("RANGE", 64), ("FLUSH", 500), ("CHUNK_BYTES", 900), ("TABLE_WORDS", 40),
                        ("PART", 6)):
        monkeypatch.setattr(collocations, name, value)
    assert want and found(spark, rows, top=4) == want


def test_collocations_of_odd_texts(spark):
    rows = ([(None, None), ("en", ""), ("en", " \t . "), ("en", "x" * 200 + " y"), ("", "p\x00q\x85r p\x00q\x85r")] * 12
            + [("en", "one\rtwo one\x0btwo One two;two")] * 11 + [("zh", "日本 語 日本 語")] * 10)
    assert found(spark, rows) == brute_collocations(rows)
    assert found(spark, []) == [] and found(spark, [(None, None)]) == []


@pytest.mark.parametrize("bits", [1, 2, 5, 20, 38, 57, 64])
def test_permutation_is_a_bijection(bits):
    p = collocations.Permutation(bits)
    rnd = np.random.default_rng(bits)
    x = np.arange(1 << bits, dtype=np.uint64) if bits < 12 else rnd.integers(0, (1 << bits) - 1, 5000, dtype=np.uint64,
                                                                             endpoint=True)
    y = p.there(x)
    assert (p.home(y) == x).all() and (bits > 63 or (y < 1 << bits).all())
    if bits < 12:
        assert np.unique(y).size == x.size


def test_filters_pack_and_merge_without_loss():
    rnd = np.random.default_rng(3)
    high, low, bits = 5, 36, 40
    parts = []
    for n in (0, 1, 700, 5000):
        v = np.unique(rnd.integers(0, 1 << low, n, dtype=np.uint64)) | np.uint64(high << low)
        c = rnd.integers(1, 600, v.size)
        got = collocations.unpack_filter(collocations.pack_filter(v, c, low, bits), high, low)
        assert (got[0] == v).all() and (got[1] == c).all()
        parts.append((v, c))
    parts.append(parts[-1])
    total = Counter()
    for v, c in parts:
        for a, b in zip(v.tolist(), c.tolist()):
            total[a] += b
    values, counts = collocations.merge(parts)
    assert dict(zip(values.tolist(), counts.tolist())) == dict(total) and (np.diff(values.astype(np.int64)) > 0).all()


# ---- line dedup, quality rules, packing: hot rows and line ends ----

OP_DOCS = "doc_id bigint, text string, lang string, source string"


def test_line_dedup_cuts_pages_of_mostly_boilerplate(spark):
    passage = " ".join(f"licence{i}" for i in range(60))
    rows = [(i, f"own {i}\n{passage}", "en", "h") for i in range(12)] + [(50 + i, f"page {i}", "en", "h") for i in range(40)]
    from panelspark.llm import line_dedup
    got = {r.doc_id: r for r in line_dedup.drop_lines(spark.createDataFrame(rows, OP_DOCS), counts=True).collect()}
    assert all(got[i].text == f"own {i}" and got[i].n_dropped == 1 for i in range(12)) and got[60].text == "page 10"
    spared = line_dedup.drop_lines(spark.createDataFrame(rows, OP_DOCS), max_loss=0.5).where("doc_id = 3").first()
    assert passage in spared.text


def test_line_dedup_broadcasts_bounded_lists_only(spark, monkeypatch):
    from panelspark.llm import line_dedup
    rows = [(i, f"own {i}\nfooter", "en", "h") for i in range(20)]
    d = spark.createDataFrame(rows, OP_DOCS)
    want = sorted(map(tuple, line_dedup.drop_lines(d).collect()))
    monkeypatch.setattr(line_dedup, "LIST_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, line_dedup.drop_lines(d).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


@pytest.mark.parametrize("end", ["\n", "\r\n", " \t\r\n", "\u0085\n", " \n"])
def test_quality_rules_agree_with_sql_on_line_ends(spark, end):
    import duckdb

    from panelspark.llm import queries
    texts = [end.join(f"Short line {i}." for i in range(30)), end.join(f"menu {i}" for i in range(40)),
             end.join(f"A longer line number {i} without an end" for i in range(20))]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = queries.quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {r["doc_id"]: r for r in con.execute(queries.ORACLE_SQL["op10_quality_rules"]).fetchdf().to_dict("records")}
    assert {r.doc_id: (r.kept, r.n_words) for r in got} == {i: (r["kept"], r["n_words"]) for i, r in want.items()}


def test_packing_spreads_repeated_rows(spark):
    from panelspark.llm import packing
    hot = "one row that stands in the table again and again " * 3
    rows = [(1, hot, "en", "s")] * 400 + [(10 + i, f"other text number {i}", "en", "s") for i in range(100)]
    out = packing.pack(spark.createDataFrame(rows, OP_DOCS), block_tokens=2000, length=512).collect()
    per = Counter()
    for r in out:
        per[r.block] += r.n_tokens
    assert len(per) > 5 and max(per.values()) < 3 * sum(per.values()) / len(per)
    assert Counter(d for r in out for d in r.doc_ids)[1] == 400


def test_near_dedup_moves_only_rows_that_may_go(spark):
    from panelspark.llm import simhash
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(40)), "en", "s")
            for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s") for i in range(20)] + [(None, rows[2][1], "en", "s"), (5, rows[7][1], "en", "s")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.drop_near_duplicates(spark.createDataFrame(rows, OP_DOCS))
        got = sorted(r.doc_id for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    assert got == sorted([*range(7), 5, *range(8, 60)])  # the second 5 leads the texts of 7


@pytest.mark.parametrize("exact", [1 << 18, 0])
def test_near_dedup_writes_few_files_and_no_row_twice(spark, monkeypatch, scratch, exact):
    """Files of small tables do not follow the shuffle partitions; few dropped
    ids part the texts in one scan, as many tasks as the input has."""
    from panelspark.llm import common, simhash
    monkeypatch.setattr(simhash, "EXACT_IDS", exact)
    paths, fresh = [], common.fresh_path
    monkeypatch.setattr(common, "fresh_path", lambda s, name: paths.append((name, fresh(s, name))) or paths[-1][1])
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(40)), "en", "s")
            for i in range(300)]
    rows += [(1000 + i, rows[i % 150][1], "en", "s") for i in range(200)]
    # pairs within one list: their edges take rounds to settle
    rows += [(2000 + i, rows[i][1] + " x1", "en", "s") for i in range(40)]
    spark.createDataFrame(rows, OP_DOCS).repartition(4).write.parquet(scratch + "/docs")
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        d = spark.read.parquet(scratch + "/docs")
        out = simhash.drop_near_duplicates(d)
        if exact:
            assert out.rdd.getNumPartitions() == d.rdd.getNumPartitions()
        got = sorted(r.doc_id for r in out.collect())
        files = [(name, len(glob.glob(path.removeprefix("file:") + "/*.parquet"))) for name, path in paths]
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert set(range(300)) <= set(got) and not [i for i in got if 1000 <= i < 2000] and len(got) == len(set(got))
    # the first edges come as they are found
    first = next(i for i, (name, _) in enumerate(files) if name == "edges")
    few = [x for i, x in enumerate(files) if i != first and x[0] not in ("simhash-fp", "simhash-filter")]
    assert {"simhash-distinct", "simhash-labels", "simhash-ids", "edges"} <= {name for name, _ in few}
    assert all(n == 1 for _, n in few), files


@pytest.mark.parametrize("exact", [1 << 18, 0])
def test_near_dedup_parts_alike_by_ids_and_by_filter(spark, monkeypatch, exact):
    from panelspark.llm import simhash
    monkeypatch.setattr(simhash, "EXACT_IDS", exact)
    one, two, three = "a b c d e f", "other words in this one here", "third text of its own here"
    rows = [(5, one), (5, two), (5, two), (7, one), (8, two), (9, three), (9, three), (None, one), (None, "bare text")]
    out = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(5, one), (5, two), (9, three), (None, "bare text")]))


@pytest.mark.parametrize("words", [1024, 4])
def test_the_filter_of_ids_parts_without_loss(spark, monkeypatch, words):
    from panelspark.llm import simhash
    monkeypatch.setattr(simhash, "FILTER_WORDS", words)
    d = spark.range(500).selectExpr("id as doc_id", "'t' as text")
    miss, hit = simhash._parted(d, "doc_id", spark.range(40).selectExpr("id * 3 as id"))
    a, b = {r.doc_id for r in miss.collect()}, {r.doc_id for r in hit.collect()}
    assert a | b == set(range(500)) and not a & b and {3 * i for i in range(40)} <= b
    assert len(b) < 60 + 440 * (words < 1024)


# ---- personal data: labels of their own ----

def iban(country, body):
    def number(s):
        return int("".join(str(int(c, 36)) for c in s))
    return f"{country}{98 - number(body + country + '00') % 97:02d}{body}"


def pii_texts(seed, n=160):
    """Texts with one variant each that the base patterns miss, and decoys."""
    rnd = random.Random(seed)
    digits = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    out = []
    for i in range(n):
        acc = iban("DE", "500105175" + digits(9))
        acc = " ".join(acc[j:j + 4] for j in range(0, len(acc), 4))
        out += [("account", f"please pay to konto {acc} soon, item {i}"),
                ("phone", f"call me on tel 0049 {rnd.randint(30, 99)} {rnd.randint(1000000, 9999999)} tonight"),
                ("email", f"write mail to user{i} (at) mail{i} (dot) example (dot) com today"),
                ("ip", f"ping the host 10[.]{rnd.randint(0, 255)}[.]{rnd.randint(0, 255)}[.]{rnd.randint(1, 254)} now"),
                (None, f"article DE{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)} {digits(2)} in stock"),
                (None, f"rows 000000000{rnd.randint(10, 99)}0000 of the log"), (None, f"meet @ noon {i} in room {digits(3)}")]
    return out


def test_every_kind_of_span_is_added(spark):
    from panelspark.llm import pii
    rows = pii_texts(1)
    out = pii.personal_data(docs(spark, [t for _, t in rows])).select("doc_id", pii.joined("base").alias("b"),
                                                                     pii.joined("spans").alias("s")).collect()
    kinds = {r.doc_id: {x.split(":")[0] for x in r.s.split(",") if x} for r in out}
    assert all(set(filter(None, r.b.split(","))) <= set(r.s.split(",")) for r in out)
    for kind in ("account", "phone", "email", "ip"):
        own = [i for i, (k, _) in enumerate(rows) if k == kind]
        other = [i for i, (k, _) in enumerate(rows) if k != kind]
        caught = sum(kind in kinds[i] for i in own) / len(own)
        wrong = sum(kind in kinds[i] for i in other) / max(1, sum(kind in kinds[i] for i in range(len(rows))))
        assert caught >= 0.9 and wrong <= 0.1, (kind, caught, wrong)


def test_account_numbers_are_verified(spark):
    from pyspark.sql import functions as F

    from panelspark.llm import pii
    good = [iban("GB", "WEST12345698765432"), iban("DE", "500105175407324931"), iban("BE", "539007547034")]
    bad = [g[:-1] + ("1" if g[-1] != "1" else "2") for g in good] + ["DE00", "XX11 2222 3333 4444"]
    df = spark.createDataFrame([(x,) for x in good + bad], "m string")
    assert [r[0] for r in df.select(pii._iban(F.col("m"))).collect()] == [True] * 3 + [False] * 5


def test_substring_chunks_stay_small():
    """What a task parses together is bounded, so that two tasks fit an executor."""
    parts = list(substring_dedup._chunks(["word " * 100] * 20_000))
    assert max(sum(map(len, p)) for p in parts) <= (1 << 20) + 500 and sum(map(len, parts)) == 20_000
