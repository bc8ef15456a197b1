"""The training-data operators on small hand-made tables: brute-force
versions, round trips, and the edge cases of their docstrings."""
import base64
import hashlib
import re
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from panelspark.llm import (bpe, components, decontaminate, line_dedup, linear_svm, packing, pii, quality_nbsvm,
                            quality_rules, simhash, toxicity, warc)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, key int, fp int, label int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def docs(spark, texts, first=0):
    """A documents table whose extra columns clash with internal names."""
    rows = [(first + i, t, "en", "s", None if t is None else len(t), 1, 2, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \t\n ", "one", "two words", LONG, "same text of five words", "same text of five words"]


# ---- components and SimHash ----

def brute_components(fps, ids, max_bits=3):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low.setdefault(find(i), []).append(d)
    return {d: min(v) for v in low.values() for d in v}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    label = {r.node: r.label for r in got.collect()}
    assert all(label[i] == 0 for i in range(41)) and label[101] == 100
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(empty).count() == 0


def test_groups_lose_no_pair():
    for max_bits in range(1, 8):
        groups = simhash.half_groups(8 - max_bits)
        from itertools import combinations
        for equal in combinations(range(8), 8 - max_bits):
            assert any(set(g) <= set(equal) for g in groups)


@pytest.mark.parametrize("block", [1, 4, 2048])
def test_linked_fingerprints_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    centre = [int(x) for x in rng.integers(0, 1 << 63, 4)]
    fps = list(dict.fromkeys(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False))
                             for c in centre for _ in range(60)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame(list(enumerate(signed)), "id bigint, fp bigint")
    got = {s: r.component_id for r in simhash.label_fingerprints(rows, 3, block).collect() for s in [r.fp]}
    want = brute_components(fps, list(range(len(fps))))
    assert [got[s] for s in signed] == [want[i] for i in range(len(fps))]


def test_list_components_with_bit_flips_equal_pairs(monkeypatch):
    rng = np.random.default_rng(2)
    low = rng.integers(0, 1 << 9, 300).astype(np.uint64)
    pairs = {int(r[0]): set(map(int, m)) for r, m in simhash.list_stars(low, 5, 3)}
    monkeypatch.setattr(simhash, "BLOCK", 1)
    monkeypatch.setattr(simhash, "_choose", lambda n, k: 0)
    assert {int(r[0]): set(map(int, m)) for r, m in simhash.list_stars(low, 5, 3)} == pairs


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] if ws else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_edge_cases(spark):
    texts = [*ODD, "Ünï À la carte  b", " em space   kept", LONG + " tail"]
    got = simhash.simhash_components(docs(spark, texts)).collect()
    assert {r.id: r.fp % (1 << 64) for r in got} == {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    label = {r.id: r.component_id for r in got}
    assert label[0] == label[1] == label[2] == 0 and label[6] == label[7] == 6 and label[10] == 5
    assert simhash.simhash_components(docs(spark, [])).count() == 0


def test_near_dedup_keeps_one_row_per_component(spark):
    d = docs(spark, ["a b c d e f", "A B C D E F", "other words in this one here", "", None])
    d = d.union(d.where("doc_id = 2")).union(docs(spark, ["lonely text without an id"]).selectExpr(
        "cast(null as bigint) doc_id", "text", "lang", "source", "n_chars", "id", "key", "fp", "label"))
    d = d.union(d.where("doc_id is null")).union(d.where("doc_id is null").selectExpr(
        "doc_id", "'a b c d e f' text", "lang", "source", "n_chars", "id", "key", "fp", "label"))
    out = simhash.drop_near_duplicates(d)
    assert out.columns == d.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect()) == [
        (False, 0, "a b c d e f"), (False, 2, "other words in this one here"), (False, 3, ""),
        (True, 0, "lonely text without an id")]
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0


def test_near_dedup_keeps_each_component_of_a_repeated_id(spark):
    texts = ["a b c d e f", "other words in this one here", "a b c d e f", "other words in this one here"]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (7, texts[0]), (8, texts[1]), (9, "third text of its own here"),
            (4, "a text with a lower id than the rest"), (5, "a text with a lower id than the rest")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, simhash.drop_near_duplicates(d).collect())) == sorted([rows[0], rows[1], rows[5], rows[6]])


# ---- WARC ----

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, key string, n int, payload int")


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 50_000
    rows = [(1, "http://a/x", "same", "k", 1, 1), (5, "http://a/y z\r\nWARC-Type: fake", "same", "k", 1, 1),
            (5, "http://a/y", "same", "k", 1, 1), (None, None, "same", "k", 1, 1), (7, None, None, "k", 1, 1),
            (8, "u", "", "k", 1, 1), (9, "u", big, "k", 1, 1)]
    archive = warc.write(pages(spark, rows))
    assert archive.payloads.count() == 3
    got = sorted(((r.id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)
                  for r in warc.read(archive).collect()), key=str)
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert got == sorted([(0, "revisit", 5, 4, sha("same")), (1, "revisit", 5, 4, sha("same")),
                          (5, "response", None, 4, sha("same")), (5, "response", None, 4, sha("same")),
                          (7, "revisit", 8, 0, sha("")), (8, "response", None, 0, sha("")),
                          (9, "response", None, len(big.encode()), sha(big))], key=str)
    for r in warc.reconstruct(archive).collect():
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        n = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert len(block) == n + 4 and block.endswith(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: re") and head.count(b"\r\nWARC-Type:") == 1
        assert b"revisit" in head.split(b"\r\n")[1] or block[:-4] == bytes(r.payload)
    small = warc.read(warc.write(pages(spark, rows[:2]), min_bytes=5)).collect()
    assert {r.record_type for r in small} == {"response"}
    assert warc.read(warc.write(pages(spark, []))).count() == 0


def test_warc_detects_changed_payloads(spark):
    a = warc.write(pages(spark, [(1, "u", "x", "k", 1, 1)]))
    bad = warc.Archive(a.headers, a.payloads.selectExpr("key", "cast('y' as binary) payload"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read(bad).collect()


# ---- BPE ----

def test_bpe_equals_the_public_library(spark):
    import tokenizers
    t = tokenizers.Tokenizer.from_file(bpe.default_path())
    texts = [*ODD, "It's <|endoftext|> we'LL ΣΑΣ İx ２０ 😀 don’t   \x1c é", "ab" * 3000 + " <|startoftext|>",
             "<|ENDOFTEXT|> naïve CAFÉ 1,000.50!!"]
    got = {r.id: r for r in bpe.encode(docs(spark, texts), decode=True).collect()}
    for i, x in enumerate(texts):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want
        assert got[i].decoded == t.decode(want, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs(spark, texts)))
    assert {r.id: r.decoded for r in again.collect()} == {i: r.decoded for i, r in got.items()}
    digests = {r.doc_id: r for r in bpe.token_digests(docs(spark, texts)).collect()}
    assert digests[0].n_tokens == 0 and digests[0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.token_digests(docs(spark, [])).count() == 0


def test_bpe_short_and_long_words_merge_alike(monkeypatch):
    with open(bpe.default_path(), encoding="utf-8") as f:
        b = bpe.Bpe(f.read())
    words = [w.encode() for w in ("the", "thethethe", "aaaaaaa", "ing" * 9, "zxqj")]
    assert [b.short_words([w])[0] for w in words] == [np.array(b._long(w), "<u4").tobytes() for w in words]
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 2)  # the cache empties all the time
    assert b.encode_batch(["a b c d e f", "f e d c b a"])[0] == b.encode("a b c d e f")


# ---- line dedup ----

def test_line_dedup_by_host(spark):
    page = "own line {} of this page which is long enough to stay\nfooter of the site\n\n \n"
    rows = [(i, page.format(i), "h1") for i in range(20)] + [(50 + i, page.format(i), "h2") for i in range(3)]
    rows += [(90, None, "h1"), (91, "", None), (92, "footer of the site\n  footer of the site ", "h1")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 key", "2 keys")
    got = {r.doc_id: r for r in line_dedup.drop_lines(d, counts=True).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "own line 3 of this page which is long enough to stay\n\n \n" and got[3].n_dropped == 1
    assert got[50].text == page.format(0)          # three pages are too few
    assert got[92].text == rows[-1][1]             # nothing would be left: a copy, not boilerplate
    assert got[90].text is None and got[90].n_lines == 0 and got[91].text == ""
    assert line_dedup.drop_lines(d).columns == d.columns
    assert line_dedup.drop_lines(d.limit(0)).count() == 0


def test_pipeline_cuts_boilerplate_from_short_pages(spark):
    import corpus_pipeline as P
    passage = " ".join(["passage"] * 55)
    rows = [(i, f"few own words {i}\n{passage}" if i < 10 else f"own page {i}", "h") for i in range(40)]
    rows += [(90, passage + "\n ", "h")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r.text for r in P.line_filter(spark, d, "").collect()}
    assert all(got[i] == f"few own words {i}" for i in range(10))
    assert got[90] == rows[-1][1] and got[20] == "own page 20" and len(got) == 41


def test_host_of_url(spark):
    from pyspark.sql import functions as F
    rows = [("https://User@Www.A.org:80/x?y#z",), ("http://b.example/",), ("no url",), (None,)]
    got = spark.createDataFrame(rows, "u string").select(line_dedup.host_of(F.col("u"))).collect()
    assert [r[0] for r in got] == ["www.a.org", "b.example", "", None]


# ---- quality rules ----

def brute_counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark):
    good = " ".join(f"word{i} and" for i in range(60)) + "."
    texts = [*(t for t in ODD if t is not LONG), good, good + "\n" + "a b c a b c a b c d", " ".join(["x y z"] * 30),
             "\n".join(["Home | News | Shop | About | Help | Login"] * 3) + "\n" + " ".join(f"v{i}" for i in range(9)) + ".",
             good + "\nAll rights reserved.", "#tag " * 60 + good[:40], "é😀 ü " * 40]
    out = quality_rules.quality_rules(docs(spark, texts)).collect()
    got = {r.doc_id: r for r in out}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(t), t
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    first = len(texts) - 7
    assert got[first].kept and got[first + 4].kept and not got[first + 2].kept and not got[first + 3].kept
    assert "All rights" not in got[first + 4].clean_text
    assert quality_rules.quality_rules(docs(spark, [LONG])).first().n_words == 30_000
    assert quality_rules.quality_rules(docs(spark, [])).count() == 0


# ---- packing ----

def test_capacity_tree_is_best_fit():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 400).tolist()
    rows = packing.best_fit_decreasing(lengths, 100)
    assert sorted(i for r in rows for i in r) == list(range(400)) and all(sum(lengths[i] for i in r) <= 100 for r in rows)
    free, want = [], []
    for i in sorted(range(400), key=lambda i: -lengths[i]):  # brute force
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - lengths[i])
        else:
            free.append(100 - lengths[i])
        want.append(sorted(free))
    assert sorted(100 - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def test_packing_is_lossless(spark):
    texts = [*ODD, "exactly"]
    out = packing.pack(docs(spark, texts), length=64, block_tokens=5000).collect()
    with open(packing.default_path(), encoding="ascii") as f:
        tok = packing.Tokens(f.read(), packing.default_pattern())
    pieces = {}
    for r in out:
        ids, pos = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert ids.size == pos.size == 64 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens:] == packing.PAD_ID).all()
        for k, d in enumerate(r.doc_ids):
            a, b = r.cu_seqlens[k:k + 2]
            assert (pos[a:b] == np.arange(b - a)).all() and r.offsets[k] == 64 * r.pieces[k]
            assert (d, r.pieces[k]) not in pieces
            pieces[d, r.pieces[k]] = ids[a:b].tobytes()
    for i, t in enumerate(texts):
        n = sum(1 for d, _ in pieces if d == i)
        assert b"".join(pieces[i, k] for k in range(n)) == tok.encode(t)
    assert len({r.block for r in out}) > 1 and packing.pack(docs(spark, [])).count() == 0


# ---- classifiers ----

def test_dual_coordinate_descent_separates():
    rows = [(np.array([0, 1]), np.array([x, 1.0])) for x in (-2.0, -1.0, 1.0, 2.0)]
    w = linear_svm.dual_coordinate_descent(rows, np.array([-1, -1, 1, 1]), 2, np.full(4, 10.0), epochs=100)
    assert abs(w[0] - 1) < 1e-2 and abs(w[1]) < 1e-2


def labelled(spark, n, bad, good, label):
    import zlib
    d = docs(spark, [(bad if i % 3 == 0 else good).format(i) for i in range(n)])
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(n)] + [(None, None), (1, 7)]
    return d, spark.createDataFrame(rows, f"doc_id bigint, {label} int"), zlib


def test_quality_model_learns_and_handles_edges(spark):
    d, lab, _ = labelled(spark, 120, "clear prose number {} goes on", "BUY!! NOW!! {}!!", "quality")
    model = quality_nbsvm.train(d, lab)
    s = {r.doc_id: r.score for r in quality_nbsvm.score(d, model).collect()}
    assert all((s[i] >= 0.5) == (i % 3 == 0) for i in range(120))
    odd = quality_nbsvm.score(docs(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    same = {r.doc_id: r.score for r in odd}
    assert same[0] == same[1] == same[2] and same[6] == same[7]
    none = quality_nbsvm.train(d, lab.limit(0))
    assert quality_nbsvm.score(d.limit(3), none).select("score").distinct().first().score == 0.5
    assert quality_nbsvm.score(d.limit(0), model).count() == 0


def test_toxicity_finds_gapped_insults(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("aeghlmnorw"), 6))
    filler = [" ".join(word() for _ in range(12)) for _ in range(240)]
    _, lab, _ = labelled(spark, 240, "", "", "toxic")
    d = docs(spark, [filler[i] + (" you " + ["stupid", "idiot"][i % 2] if i % 3 == 0 else " with study and ideas")
                     for i in range(240)])
    model = toxicity.train(d, lab)
    texts = ["a stupid thing", "a s t u p i d thing", "a st-upid thing", "a s.t.u.p.i.d thing", "a study of ideas", None, "", LONG,
             "what an idi0t"]
    s = [r.score for r in toxicity.score(docs(spark, texts), model).orderBy("doc_id").collect()]
    assert min(s[:4]) >= 0.5 and s[8] >= 0.5 and max(s[4:8]) < 0.5
    kept = toxicity.score(d, model, keep=True)
    assert kept.columns == [*d.columns, "__score"]
    assert kept.where("(__score >= 0.5) <> (doc_id % 3 = 0)").count() == 0
    assert toxicity.score(d.limit(0), model).count() == 0
    assert toxicity.train(d, lab.limit(0)).constant == 0.5


def test_toxicity_fit_holds_little_on_the_driver():
    """Kernel weights of the triples that occur, not of every triple of a large
    alphabet; counts of clean rows only for openings that toxic rows have."""
    rng = np.random.default_rng(4)
    chars = [chr(c) for c in range(0x430, 0x430 + 120)]
    words = ["".join(rng.choice(chars, int(rng.integers(3, 9)))) for _ in range(100)]

    def kernel(a, b):
        def triples(w):
            out = Counter()
            for i, j, k in combinations(range(len(w)), 3):
                if k - i - 2 <= toxicity.MAX_SKIP:
                    out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i - 2)
            return out
        x, y = triples("<" + a + ">"), triples("<" + b + ">")
        return sum(v * y[t] for t, v in x.items()) / (toxicity._size(len(a) + 2) * toxicity._size(len(b) + 2))

    tracemalloc.start()
    values = toxicity.landmark_spans(words).values(words)
    most = tracemalloc.get_traced_memory()[1]
    clean = [["".join(rng.choice(list("abcdefgh"), 12)) for _ in range(200)] for _ in range(100)]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    witness, rest = toxicity._witnesses([["stupid", "plain"]] * 3 + [["stupidly", "other"]] * 3, clean + [["plain"]])
    counted = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert most < 40 << 20 and counted < 10 << 20  # every triple and opening: 736 and 63 MB
    assert np.allclose(values, [[kernel(a, b) for b in words] for a in words], atol=1e-5)
    assert witness == {"stupid": 1, "stupidly": 1} and set(rest) == {"plain", *(w for b in clean for w in b)}


# ---- decontamination ----

def test_lcs_equals_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = ([bytes([x]) for x in rng.integers(0, 5, rng.integers(1, 40))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert decontaminate.lcs(a, b) == row[-1]


def test_leaks_exact_and_paraphrased(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    items = [" ".join(word() for _ in range(40)) + ". " + " ".join(word() for _ in range(6)) + "." for _ in range(12)]
    edited = items[1].split()
    for i in range(0, len(edited), 8):
        edited[i] = "changed"
    noise = lambda: " ".join(word() for _ in range(120))
    phrase = " ".join(items[2].split()[:9])
    texts = [f"{noise()} {items[0].upper()} {noise()}", f"{noise()} {' '.join(edited)} {noise()}", f"{noise()} {phrase} {noise()}",
             noise(), None, "", LONG, items[3]]
    d = docs(spark, texts)
    b = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, items[3])], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    assert got == {(0, 0), (1, 1), (7, 3), (7, 52)}
    kept = decontaminate.drop_leaks(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6]
    assert decontaminate.leaks(d, b.limit(0)).count() == 0 and decontaminate.leaks(d.limit(0), b).count() == 0


def test_leaks_behind_a_decoy(spark):
    """A quoted passage nearer than the copy does not hide the copy."""
    rng = np.random.default_rng(16)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    items = [[word() for _ in range(40)] for _ in range(12)]
    noise = lambda n: [word() for _ in range(n)]
    texts = [" ".join([*noise(32), *items[k][:16], *noise(139), *items[k], *noise(60)]) for k in range(3)]
    texts += [" ".join([*noise(32), *items[3][:16], *noise(139)])]
    b = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, texts), b).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}
    assert [r.doc_id for r in decontaminate.drop_leaks(docs(spark, texts), b).collect()] == [3]


def test_leaks_with_fewer_directions_than_passages(spark):
    """Copies are found however little of a passage the latent space holds."""
    rng = np.random.default_rng(17)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(3000)]
    word = lambda: vocabulary[rng.integers(3000)]
    items = [" ".join(word() for _ in range(20)) for _ in range(60)]
    texts = [" ".join([*(word() for _ in range(100)), t, *(word() for _ in range(100))]) for t in items]
    b = spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, texts), b, rank=2).collect()}
    assert got == {(i, i) for i in range(60)}


def test_leaks_of_the_most_copied_item(spark):
    """An item whose copies make all its words frequent is found in each, and
    so is an item of frequent words alone."""
    rng = np.random.default_rng(19)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    hot, plain = [[word() for _ in range(16)] for _ in range(2)]
    texts = [" ".join(hot)] * 20 + [" ".join(word() for _ in range(30)) for _ in range(40)]
    texts += [" ".join([*(word() for _ in range(20)), *plain])]
    b = spark.createDataFrame([(0, " ".join(hot)), (1, " ".join(plain)), (2, " ".join(hot[:15]))], "item_id bigint, text string")
    out = decontaminate.leaks(docs(spark, texts), b).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(i, k) for i in range(20) for k in (0, 2)} | {(60, 1)}
    assert all(r.similarity > 0.5 for r in out)


def test_candidates_equal_brute_force():
    """All windows of all texts verified, against the listed ones."""
    rng = np.random.default_rng(18)
    draw = lambda n: [f"w{int(x)}" for x in rng.zipf(1.3, n) % 400]
    items = [draw(n) for n in [1, 2, 5, 16, 30, 45, 200, 30, 8]]
    its = decontaminate.Items.of([(i, " ".join(t), None) for i, t in enumerate(items)])
    index = decontaminate.Index(its, np.zeros((its.size, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, int))
    total = 0
    for n in (5, 100, 900, 3000):
        for t in items:
            a = int(rng.integers(n))
            text = [*draw(a), *(x if rng.random() < 0.8 else "other" for x in t), *draw(n - a)]
            words = decontaminate.tokens(" ".join(text))
            want = {k for k in range(len(items)) for w in range(-(-len(words) // decontaminate.PASSAGE))
                    if index._verified(k, words, w)}
            assert {h[0] for h in index.hits(" ".join(text))} == want
            total += len(want)
    assert total > 36


def test_latent_cosines_propose_the_candidates(spark):
    """Without lists the latent space alone loses no item that can be verified;
    spoilt vectors lose them; with few directions the lists come in."""
    rng = np.random.default_rng(20)
    draw = lambda n: [f"w{int(x)}" for x in rng.zipf(1.3, n) % 400]
    items = [draw(n) for n in [1, 2, 5, 16, 30, 45, 200, 30, 8]]
    texts = [" ".join([*draw(a), *(x if rng.random() < 0.8 else "other" for x in t), *draw(n - a)])
             for n in (5, 100, 900, 3000) for t in items for a in [int(rng.integers(n))]]
    its = decontaminate.Items.of([(i, " ".join(t), None) for i, t in enumerate(items)])
    index = decontaminate.build(docs(spark, texts), its)
    assert index.held.tolist() == list(range(len(items))) and not index.post_item.size

    def found(index):
        return [{h[0] for h in index.hits(t)} for t in texts]
    want = []
    for t in texts:
        words = decontaminate.tokens(t)
        want.append({k for k in range(len(items)) for w in range(-(-len(words) // decontaminate.PASSAGE))
                     if index._verified(k, words, w)})
    assert found(index) == want and sum(map(len, want)) > 36
    few = decontaminate.build(docs(spark, texts), its, rank=3)
    assert few.held.size < len(items) and few.post_item.size and found(few) == want
    index.vectors = np.zeros_like(index.vectors)
    assert sum(map(len, found(index))) < sum(map(len, want)) / 2


def test_benchmark_blocks_are_bounded_by_passages(spark, monkeypatch):
    rng = np.random.default_rng(21)
    items = [" ".join(f"w{x}" for x in rng.integers(0, 300, 40)) for _ in range(30)]
    texts = [f"{'other words ' * 40}{t} and more" for t in items[::3]]
    b = spark.createDataFrame([*enumerate(items), (90, None)], "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 20)
    blocks = list(decontaminate._blocks(b, "item_id", "text"))
    assert len(blocks) > 2 and sorted(i for x in blocks for i in x.ids) == list(range(30))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, texts), b).collect()}
    assert got == {(i, 3 * i) for i in range(10)}
    assert decontaminate.drop_leaks(docs(spark, [*texts, "clean"]), b).count() == 1


def test_filters_send_only_texts_to_python(spark):
    """Rows stay in the JVM while their texts are judged (toxicity, leaks)."""
    d = docs(spark, ["one two three four", None, ""])
    b = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    left = decontaminate.drop_leaks(d, b)
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id bigint, toxic int")
    scored = toxicity.score(d, toxicity.train(d, labels), keep=True)
    assert scored.columns == [*d.columns, "__score"] and left.dtypes == d.dtypes
    for out, n in ((left, 2), (scored, 3)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and "MapInArrow" not in plan and out.count() == n


def test_randomised_svd_finds_the_leading_directions(spark):
    rng = np.random.default_rng(8)
    a = rng.standard_normal((30, 4)) @ rng.standard_normal((4, 25))
    rows = spark.createDataFrame([(list(range(25)), [float(x) for x in r]) for r in a], "t array<int>, v array<float>").repartition(3)
    v = decontaminate.randomised_svd(rows, 25, 4)
    assert v.shape == (25, 4) and np.allclose(a @ v @ v.T, a, atol=1e-3)


# ---- personal data ----

def brute_spans(text):
    def luhn(d):
        return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(d)) for x in [int(c) << (i % 2)]) % 10 == 0
    out = []
    for k, (kind, rx, ok) in enumerate([
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 12 <= len(d) <= 19 and luhn(d)),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15)]):
        for m in re.finditer(rx, text or ""):
            if ok(m.group(), re.sub("[^0-9]", "", m.group())):
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PERSONAL = [
    "a@b.c_d@x.y😀 x@y.zz, ..a@b..c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (456) 555-2186 +12 +1-2-3-4-5-6-7-8 é +49 30 1234567.", "😀😀 mail me: someone@example.com", "@@ a@b @c.d + ++1 234 567 890",
    "9" * 40_000, "x" * 200_000 + "@a.b", "1 " * 20_000, "1.1.1.1 " * 3000, "+" * 50_000, "a@b.c " * 3000]


def test_base_spans_equal_python(spark):
    texts = [*ODD, *PERSONAL]
    out = pii.personal_data(docs(spark, texts))
    got = {r.doc_id: r.b for r in out.select("doc_id", pii.joined("base").alias("b")).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(texts)}
    assert pii.personal_data(docs(spark, [])).count() == 0


def test_boosting_adds_spans_and_keeps_base_ones(spark):
    texts = [f"call me by phone +1 (456) 555-{1000 + i} soon, item {i}" for i in range(120)]
    texts += [f"write mail to user{i}@mail{i}.example.com today" for i in range(120)]
    texts += ["call me by phone (456) 555-7777 soon", "write mail to user7 (at) mail7.example.com today", "total 12-34 of 5 items"]
    out = {r.doc_id: r for r in pii.personal_data(docs(spark, texts)).collect()}
    assert all(set(r.base) <= set(r.spans) for r in out.values())
    assert len(out[241].spans) == 1 and not out[241].base and len(out[242].spans) == 0
    red = {r.doc_id: r.text for r in pii.redact(docs(spark, texts)).collect()}
    assert red[3] == "call me by phone [REDACTED] soon, item 3" and red[242] == texts[242]


def test_clashing_column_names(spark):
    """Tables whose other columns are named like the results."""
    d = docs(spark, ["x@y.zz " * 30, "line\nline"]).selectExpr(
        "*", "1 email", "2 base", "3 spans", "4 n_lines", "5 n_words", "6 kept", "7 n", "8 ids", "9 block", "10 host", "11 keys")
    got = pii.personal_data(d)
    assert got.columns.count("spans") == 1 and len(got.where("doc_id = 0").first().spans) == 30
    assert line_dedup.drop_lines(d, counts=True).where("doc_id = 1").first().n_lines == 2
    assert quality_rules.quality_rules(d).where("doc_id = 0").first().n_words == 30
    assert bpe.token_digests(d).count() == simhash.simhash_components(d).count() == 2
    assert packing.pack(d).first().n_tokens > 30 and simhash.drop_near_duplicates(d).columns == d.columns


def test_packing_tokens_equal_the_public_library():
    with open(packing.default_path(), encoding="ascii") as f:
        tok = packing.Tokens(f.read(), packing.default_pattern())
    rng = np.random.default_rng(12)
    parts = ["a", "The", "don't", " ", "  ", "\n", "\n\n", "\t", ",", "é", "\xa0", "12", "!!", "\x1c", "😀", "word's"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(3000)]
    for t in [*texts, " lead", "trail ", "one two, three.\nfour five", LONG]:
        assert np.frombuffer(tok.encode(t), "<u2").tolist() == tok.encoding.encode_ordinary(t), repr(t)
