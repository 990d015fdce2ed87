"""The text operators against brute force on small tables, edge rows among them."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimloom.llm import exact, fingerprint, html, langid, license, lm, mixing, packing, quality, simhash
from claimloom.llm.catalog import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, size string, fp string, lang_pred string"
LONG = "Lorem ipsum dolor sit amet. " * 20_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "THE quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n ", "de", "b"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund\nReleased under the MIT License.", "de", "c"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund\nReleased under the MIT License.", "de", "c"),
    (7, "12 34 !!", "en", None),
    (None, "no id at all", "en", "c"),
    (None, "no id at all", "en", "c"),
    (8, "É 漢字 мир <|endoftext|> x", None, "é"),
    (9, LONG, "en", "a"),
]


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, "s", "f", "x") for row in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing_round_trip(docs, none):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = packing.pack(docs, keep=("doc_id", "text")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0 for r in rows)
    joined = {}
    for r in sorted(rows, key=lambda r: r.start):
        joined.setdefault((r.doc_id, r.text), []).append(np.frombuffer(r.ids, "<u4"))
    copies = Counter((row[0], row[1]) for row in TEXTS)
    for (doc_id, text), parts in joined.items():
        n = copies[doc_id, text]
        want = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        if n == 1:
            assert np.concatenate(parts).tolist() == want
        assert sum(len(p) for p in parts) == n * len(want)
    assert packing.pack(none).count() == 0
    assert packing.piece_lengths(2 * 1024 + 5) == [1024, 1024, 4, 1]


def test_packing_reads_runs_the_fast_encoder_gives_up_on():
    encoder = packing.Encoder()
    for text in (" " * 300_000 + "x", "a   \n\n  b", "<|endoftext|>"):
        assert encoder(text) == encoder.slow(text)


def test_exact_duplicates_against_brute_force(docs, none):
    rows = exact.duplicates(docs, hash_all=True).collect()
    groups = {}
    for doc_id, text, *_ in TEXTS:
        groups.setdefault(hashlib.sha256(lowered(text).encode()).hexdigest(), []).append(doc_id)
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = groups[r.full_hash]
        known = [i for i in ids if i is not None]
        assert (r.group_size, r.keep_id) == (len(ids), max(known) if known else None)
    assert Counter(r.full_hash for r in rows if r.kept) == Counter(groups.keys())
    kept = exact.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(hashlib.sha256(lowered(r.text).encode()).hexdigest() for r in kept.collect()) == sorted(groups)
    assert exact.duplicates(none).count() == exact.drop_duplicates(none).count() == 0


def test_exact_dedup_is_the_same_beyond_the_broadcast_bound(docs, monkeypatch):
    want = sorted(map(str, exact.duplicates(docs, hash_all=True).collect()))
    monkeypatch.setattr(exact, "broadcast_if_small", lambda df, rows=0: df)
    assert sorted(map(str, exact.duplicates(docs, hash_all=True).collect())) == want


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_simhash_against_all_pairs(spark, docs, none, sf_dir):
    for frame in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        prints = [plain_simhash(t) for _, t in rows]
        roots = plain_components(prints)
        ids = {}
        for (doc_id, _), root in zip(rows, roots):
            ids.setdefault(root, []).append(doc_id)
        first = {root: min((i for i in x if i is not None), default=None) for root, x in ids.items()}
        want = Counter((d, p, first[r]) for (d, _), p, r in zip(rows, prints, roots))
        got = simhash.near_duplicates(frame).collect()
        assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
        assert simhash.keep_first(frame).count() == len(first)
    assert simhash.near_duplicates(none).count() == simhash.keep_first(none).count() == 0


@pytest.mark.parametrize("shared", [1, 2, 4])
def test_gray_index_and_tiles_find_all_links(spark, monkeypatch, shared):
    monkeypatch.setattr(simhash, "CHUNK", 64)
    random = np.random.default_rng(3)
    centres = random.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = set(random.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    for c in centres.tolist():
        for _ in range(120):
            flips = random.choice(64, random.integers(0, 4), replace=False)
            prints.add(c ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    labels = {r.node: r.label for r in simhash.components(simhash.links(frame, shared)).collect()}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    want, got = {}, {}
    for p, root in zip(signed, plain_components(prints)):
        want.setdefault(root, set()).add(p)
        got.setdefault(labels.get(p, p), set()).add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_bands_cover_all_bits_and_grow_with_the_rows():
    for shared in range(1, 5):
        masks = simhash.band_masks(shared)
        assert np.bitwise_or.reduce(np.array(masks, np.uint64)) == (1 << 64) - 1
        assert len(masks) == len(set(masks)) == math.comb(4 + shared, shared)
    assert [simhash.shared_bands(n) for n in (0, 1 << 22, (1 << 22) + 1, 10**9, 10**10, 10**12)] == [1, 1, 2, 2, 3, 4]


def test_mixing_meets_targets_and_reruns_agree(docs, none):
    taken, planned = mixing.mix(docs, block_words=4)
    rows = taken.collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    per_source = {}
    for r in rows:
        per_source.setdefault((r.source, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= 1 for (_, target), t in per_source.items())
    again, _ = mixing.mix(docs, block_words=64)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    words = planned.slots.groupBy("rank").agg(F.max("turn").alias("last"), F.count("*").alias("n")).collect()
    assert all(w.last + 1 == w.n for w in words)
    repeated = mixing.repeat_documents(docs)
    assert repeated.columns == docs.columns
    assert mixing.mix(none)[0].count() == mixing.repeat_documents(none).count() == 0


def test_fingerprints_add_subtract_and_follow(spark, docs, none):
    pair = spark.createDataFrame([("a b.\nc d.", "c d.", "c d.\na b.", "a b.")], "x string, y string, z string, w string")
    made = fingerprint.with_vectors(pair.toDF("tx", "ty", "tz", "tw"), x="tx", y="ty", z="tz", w="tw")
    row = made.select(
        (F.col("x") == F.col("z")).alias("order"),
        (fingerprint.insert(F.col("w"), F.col("y")) == F.col("x")).alias("added"),
        (fingerprint.delete(F.col("x"), F.col("y")) == F.col("w")).alias("removed"),
    ).first()
    assert row.order and row.added and row.removed
    unique = [(i, t) for i, t, *_ in sorted({(r[0], r[1], "", "") for r in TEXTS if r[0]}, key=lambda r: r[0])]
    frame = spark.createDataFrame(unique, "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprint.compare_edits(frame).collect()}
    for k, (doc_id, text) in enumerate(unique):
        own, after = text or "", unique[(k + 1) % len(unique)][1] or ""
        half = len(own) // 2
        assert rows[doc_id].edited == own[: len(own) - half] + after[:half]
        assert rows[doc_id].n_chars == len(own)
        assert 0 <= rows[doc_id].near_next <= 1 and 0 <= rows[doc_id].near_edited <= 1
    assert fingerprint.compare_edits(docs).count() == len(TEXTS)
    assert fingerprint.compare_edits(none).count() == 0


def test_following_text_over_many_ranges(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 20_000)
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in frame.orderBy("doc_id").collect()]
    rows = fingerprint.with_following(frame).select("doc_id", "following.text").orderBy("doc_id").collect()
    assert [r.text for r in rows] == texts[1:] + texts[:1]


def test_language_edges_and_held_out_accuracy(spark, docs, none, sf_dir):
    rows = langid.learn_and_identify(docs, keep=("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == has_letter and 0 <= r.score <= 1
    assert langid.keep_identified(docs).columns == docs.columns
    assert langid.learn_and_identify(none).count() == langid.keep_identified(none).count() == 0
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.learn_and_identify(real, keep=("doc_id", "lang")).where(langid.held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_viterbi_is_the_best_path():
    random = np.random.default_rng(1)
    sizes = np.array([1, 5, 0, 4])
    scores = random.normal(0, 3, (sizes.sum(), 3))
    labels = langid.best_paths(scores, sizes, 2.0)
    begin = 0
    for n in sizes:
        part, best = scores[begin : begin + n], -np.inf
        for code in range(3**n if n else 0):
            path = [code // 3**i % 3 for i in range(n)]
            best = max(best, sum(part[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:])))
        if n:
            own = labels[begin : begin + n]
            value = part[np.arange(n), own].sum() - 2.0 * (np.diff(own) != 0).sum()
            assert value == pytest.approx(best)
        begin += n


def test_mixed_language_spans(spark, sf_dir):
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(real)
    by_lang = {r.lang: r.text[:400] for r in real.where("n_chars > 500").collect()}
    one = spark.createDataFrame([(1, by_lang["de"] + "\n" + by_lang["fr"])], "doc_id long, text string")
    row = langid.identify(one, model).first()
    assert [x for x in row.span_langs if x in ("de", "fr")][0] == "de" and row.span_langs[-1] == "fr"


def test_quality_edges_and_held_out_accuracy(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, None), (None, 1)], "doc_id long, quality int")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.score == 0.5 for r in quality.score(docs, labels.limit(0)).collect())
    assert quality.score(none, labels).count() == 0
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op3_quality"](spark, sf).where("held_out")
    truth = spark.read.parquet(f"{sf}/labels.parquet")
    assert scored.join(truth, "doc_id").where("predicted = quality").count() > 0.95 * scored.join(truth, "doc_id").count()


def test_lm_scores_prefer_the_target(spark, docs, none):
    target = spark.createDataFrame([(i, "red green blue red green blue") for i in range(20)], "item_id long, text string")
    corpus = spark.createDataFrame(
        [(i, "one two three four five six") for i in range(40)] + [(100, "red green blue red green"), (101, None)],
        "doc_id long, text string",
    )
    scores = {r.doc_id: r for r in lm.score(corpus, target).collect()}
    assert scores[100].score < 0 < scores[0].score and (scores[101].n_tokens, scores[101].score) == (0, 0.0)
    rows = lm.score(docs, target).collect()
    assert len(rows) == len(TEXTS)
    assert Counter(r.n_tokens for r in rows) == Counter(len((t or "").encode().split()) for _, t, *_ in TEXTS)
    assert lm.score(none, target).count() == 0
    assert lm.score(docs, target.limit(0)).count() == len(TEXTS)


def plain_lm(texts, target):
    """Per text its tokens and mean bits, one token at a time from plain counters."""

    def counts(all_words):
        return Counter(w for ws in all_words for w in ws), Counter(p for ws in all_words for p in zip(ws, ws[1:]))

    def cost(words, single, pair, mass, factor):
        bits = 0.0
        for i, w in enumerate(words):
            p = 0.95 * single[w] / mass + 0.05 / 65536 if mass else 0.05 / 65536
            if i:
                before = factor * single[words[i - 1]]
                given = min(pair[words[i - 1], w] / single[words[i - 1]], 1) if before else 0
                p = before / (before + 5) * given + 5 / (before + 5) * p
            bits -= np.log2(min(p, 1))
        return bits / max(len(words), 1)

    split = [lowered(t).encode().split() for t in texts]
    wanted = [lowered(t).encode().split() for t in target]
    (t1, t2), (c1, c2) = counts(wanted), counts(split)
    factor = t1.total() / max(c1.total(), 1) if t1 else 1.0
    for words in split:
        o1, o2 = counts([words])
        rest = c1 - o1
        yield len(words), cost(words, t1, t2, t1.total(), 1.0), cost(words, rest, c2 - o2, rest.total(), factor)


def test_lm_scores_against_plain_counters(spark, docs, sf_dir, monkeypatch):
    sample = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    wanted = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for chars in (lm.GROUP_CHARS, 50_000):  # one group a batch, and many
        monkeypatch.setattr(lm, "GROUP_CHARS", chars)
        for corpus, target in ((sample, wanted), (docs, wanted.limit(0)), (docs, wanted)):
            rows = sorted(map(tuple, corpus.select("doc_id", "text").collect()), key=str)
            expected = plain_lm([t for _, t in rows], [r.text for r in target.collect()])
            expected = sorted((str(i), n, round(a, 6), round(b, 6)) for (i, _), (n, a, b) in zip(rows, expected, strict=True))
            got = lm.score(corpus, target).collect()
            assert all(r.score == r.target_bits - r.background_bits for r in got)
            got = sorted((str(r.doc_id), r.n_tokens, round(r.target_bits, 6), round(r.background_bits, 6)) for r in got)
            assert [x[:2] for x in got] == [x[:2] for x in expected]
            assert np.allclose([x[2:] for x in got], [x[2:] for x in expected], atol=1e-5)


def test_licenses_edges(spark, docs, none):
    extra = [
        (20, "mit license mit license x GNU general-public LICENSE", "cc by"),
        (21, "This work is under permitted terms\nLicensed under CC BY-NC 4.0!", None),
        (22, "summit license commit licenses", None),
    ]
    rows = {r.doc_id: r for r in license.scan(spark.createDataFrame(extra, "doc_id long, text string, label string")).collect()}
    assert (rows[20].n_base, rows[20].first_word, rows[20].last_word, rows[20].base_labels) == (3, 0, 5, ["gpl", "mit"])
    assert rows[21].labels == ["cc-by", "cc-by-nc"] and rows[21].first_word == 8
    assert (rows[22].n_base, rows[22].first_word, rows[22].score) == (0, None, 0.0)
    found = license.scan(docs).collect()
    assert len(found) == len(TEXTS) and sum(r.labels == ["mit"] for r in found) == 2
    assert license.scan(none).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</li></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; line</h1><p>First\n  block<br>here"
        "<div class=ad>Buy</div><p>Ok.</p><form>Mail<input></form><section id=comments><p>Nice!</p></section>"
        "</article><aside>Side</aside><footer>&copy; x</footer><script>var t='</p>'</script>"
    )
    assert html.main_text(page) == ["Head & line", "First block here", "Ok."]
    plain = "<body><div id=menu>a b</div><p>" + "long text " * 20 + "</p><p>Short.</p><p>" + "more text " * 20 + "</p></body>"
    assert [b[:5] for b in html.main_text(plain)] == ["long ", "Short", "more "]
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", page, "x"), (None, None, None, "x"), (2, "u", "<p", "x"), (2, "u", "<p", "x")], schema)
    rows = html.extract(pages).collect()
    assert [r.text for r in rows] == ["Head & line\n\nFirst block here\n\nOk.", "", "", ""]
    assert html.extract(pages.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark, sf_dir):
    import corpus_pipeline
    from test_whole_jobs import plain_first

    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf_dir))
    start = frames[0].collect()
    shares = {}
    for r in langid.learn_and_identify(frames[0]).collect():
        sizes = [(one, end - start) for one, start, end in zip(r.span_langs, r.span_starts, r.span_ends)]
        shares[r.doc_id] = sum(n for one, n in sizes if one == r.lang_pred) / max(1, sum(n for _, n in sizes))
    lettered = [r for r in start if any(c.isalpha() for c in r.text or "") and shares[r.doc_id] >= langid.MIN_SHARE]
    best = {}
    for r in lettered:
        key = lowered(r.text)
        best[key] = max(best.get(key, r), r, key=lambda x: x.doc_id)
    unique = sorted(best.values(), key=lambda r: r.doc_id)
    assert sorted(r.doc_id for r in frames[1].collect()) == sorted(r.doc_id for r in lettered)
    assert sorted(r.doc_id for r in frames[2].collect()) == [r.doc_id for r in unique]
    assert sorted(r.doc_id for r in frames[3].collect()) == plain_first([(r.doc_id, r.text) for r in unique])
    assert all(f.columns == frames[0].columns for f in frames[:-1])
    mixed = Counter(r.doc_id for r in frames[4].collect())
    taken = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(frames[3])[0].collect() if r.size}
    assert mixed == Counter({k: n for k, n in taken.items() if n})
    packed = frames[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    assert {r.doc_id: r.n for r in packed} == {r.doc_id: r.d * mixed[r.doc_id] for r in packed}


def test_twins(spark, sf_dir):
    import compare

    from claimloom.llm.catalog import ORACLE

    con = compare.connect(sf_dir)
    for key, sql in ORACLE.items():
        assert compare.differences(QUERIES[key](spark, sf_dir), con, sql) == []
