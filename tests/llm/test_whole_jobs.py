"""Cases in which the text operators once did less than the whole job."""

import numpy as np
from pyspark.sql import functions as F

from claimloom.llm import exact, jaccard, langid, mixing, quality, simhash


def plain_likeness(a, b):
    sets = []
    for text in (a, b):
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def plain_first(rows):
    """The smallest id of every component of texts with 0.8 of their five-word shingles in common."""
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if plain_likeness(a, b) >= 0.8:
                root[top(i)] = top(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        first[top(i)] = min(first.get(top(i), doc_id), doc_id)
    return sorted(first.values())


def test_near_copies_beyond_four_bits_are_dropped(spark, sf_dir):
    import corpus_pipeline

    random = np.random.default_rng(5)
    rows = []
    for k in range(40):
        words = [f"w{n}" for n in random.integers(0, 100_000, 150)]
        rows.append((2 * k, " ".join(words)))
        for at in (40, 90, 140)[: k % 4]:  # 15 of 161 shingles differ at most: 0.81 and more
            words[at] = "other"
        rows.append((2 * k + 1, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = sorted(r.doc_id for r in stage(spark, frame, sf_dir).collect())
    assert kept == plain_first(rows) == list(range(0, 80, 2))
    prints = [simhash.fingerprint_of(text) for _, text in rows]
    assert any((a ^ b).bit_count() > 4 for a, b in zip(prints[::2], prints[1::2]))
    real = exact.drop_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = sorted((r.doc_id, r.text) for r in real.collect())
    assert sorted(r.doc_id for r in stage(spark, real, sf_dir).collect()) == plain_first(rows)


def test_near_copies_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "A  b"), (None, "a b"), (5, "a b c"), (6, "a b c d e f")]
    frame = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, fp string")
    kept = jaccard.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    assert jaccard.keep_first(frame.limit(0)).count() == 0


def test_a_chain_of_likenesses_is_one_component(spark):
    words = [f"w{n}" for n in range(200)]
    rows = []
    for k in range(12):  # neighbours are alike, the ends are not
        rows.append((k, " ".join(words)))
        words[15 * k] = words[15 * k + 7] = "new"
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain_likeness(rows[0][1], rows[-1][1]) < 0.8
    assert [r.doc_id for r in jaccard.keep_first(frame).collect()] == plain_first(rows) == [0]


def test_lettered_texts_stay_without_a_language_to_learn_from(spark):
    rows = [(1, "Some words", None), (2, "12 34 !!", None), (3, None, None), (4, "слово", None), (5, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = langid.keep_identified(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]
    folds = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("one word").alias("text"))
    held = folds.withColumn("lang", F.when(langid.held_out(), "en"))  # a language in the held-out fold alone
    assert held.where("lang is not null").count() and langid.keep_identified(held).count() == 50


def test_many_sources_are_ranked_by_ranges(spark, monkeypatch):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('word ', cast(1 + id % 7 as int))").alias("text"),
        F.expr("nullif(concat('host', id % 500), 'host7')").alias("source"),
    )
    results, plans = [], []
    for bound, rows in ((200_000, 1 << 16), (10, 64)):
        monkeypatch.setattr(mixing, "ROWS_PER_RANGE", rows)
        monkeypatch.setattr(mixing, "broadcast_if_small", lambda df, bound=bound: F.broadcast(df) if df.count() <= bound else df)
        taken, planned = mixing.mix(docs, block_words=4)
        results.append(sorted(map(str, taken.collect())))
        slots = planned.slots
        plans.append(slots._jdf.queryExecution().optimizedPlan().toString())
        results.append(sorted(map(tuple, slots.collect())))
        ranks = [r["rank"] for r in planned.sources.orderBy(F.col("source").asc_nulls_last()).collect()]
        assert ranks == list(range(1, 501))
    assert results[:2] == results[2:]
    assert "broadcast" in plans[0] and "broadcast" not in plans[1]


def near_copy_rows(groups=12, copies=9, seed=11):
    """Texts around shared passages: copies with some words changed, and other texts that hold the same passage."""
    random = np.random.default_rng(seed)
    words = [f"w{n}" for n in random.integers(0, 100_000, 4000)]
    passage, rows = words[:90], []
    for g in range(groups):
        own = words[100 + 40 * g : 100 + 40 * g + 12 + 3 * g]
        for _ in range(copies):
            text = [*own, *passage, *words[3000 + 30 * g : 3000 + 30 * g + 5 + 2 * g]]
            for at in random.integers(0, len(text), int(random.integers(0, 4))):
                text[at] = f"x{random.integers(0, 1000)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def test_every_way_of_meeting_finds_the_same_near_copies(spark, monkeypatch):
    rows = near_copy_rows()
    want = plain_first(rows)
    assert 1 < len(want) < len(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for stars, texts, shingles, small in ((2, 256, 1 << 21, True), (0, 7, 1 << 21, False), (0, 256, 500, True)):
        monkeypatch.setattr(jaccard, "STAR_ROUNDS", stars)
        monkeypatch.setattr(jaccard, "TILE_TEXTS", texts)
        monkeypatch.setattr(jaccard, "TILE_SHINGLES", shingles)
        if not small:
            monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df, rows=0: df)
        assert sorted(r.doc_id for r in jaccard.keep_first(frame).collect()) == want


def test_the_prefix_join_leaves_out_no_pair(spark):
    rows = near_copy_rows(8, 6, 3)
    sets = [jaccard.hashes_of(jaccard.words_of(t)).view(np.int64).tolist() for _, t in rows]
    texts = spark.createDataFrame([(i, i, s) for i, s in enumerate(sets)], "fp long, label long, set array<long>")
    pairs = jaccard.prefix_pairs(texts.select("fp", "label"), texts.select("fp", "set"))
    met = {(r.a, r.b) for r in pairs.collect()}
    alike = {(i, j) for j in range(len(rows)) for i in range(j) if plain_likeness(rows[i][1], rows[j][1]) >= 0.8}
    assert alike and alike <= met and len(met) < len(rows) * (len(rows) - 1) / 2
    found = jaccard.compared(pairs, texts.select("fp", "set"))
    assert {(r.a, r.b) for r in found.collect()} == alike


def test_texts_of_a_large_group_that_are_not_alike_enough_make_no_rows_by_pairs(spark, monkeypatch):
    random = np.random.default_rng(8)
    passage = [f"w{n}" for n in random.integers(0, 100_000, 150)]
    rows = []
    for k in range(160):  # two texts share about 0.55 to 0.85 of their shingles
        text = list(passage)
        for at in random.integers(0, 30, 3 + k % 2):
            text[5 * at] = f"x{random.integers(0, 3)}"
        rows.append((k, " ".join(text)))
    pairs, compared = [], jaccard.compared
    monkeypatch.setattr(jaccard, "compared", lambda met, sets: pairs.append(met.count()) or compared(met, sets))
    monkeypatch.setattr(jaccard, "TILE_TEXTS", 16)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_first(rows)
    assert 1 < len(want) < len(rows)
    assert sorted(r.doc_id for r in jaccard.keep_first(frame).collect()) == want
    assert sum(pairs) < 2 * len(rows)


def test_near_copies_of_very_long_and_repeated_texts(spark):
    long = " ".join(f"n{k}" for k in range(150_000))
    rows = [(5, long), (3, long + " more"), (3, long + " more"), (9, "other " + long), (None, "alone here"), (None, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(frame).collect()}
    assert found == {(5, 3), (3, 3), (9, 3), (None, None)}
    assert sorted(str(r.doc_id) for r in jaccard.keep_first(frame).collect()) == ["3", "None"]


def test_texts_that_length_or_prefix_tell_apart_are_not_hashed(spark, monkeypatch):
    rows = [(k, "x" * (k + 1), ) for k in range(300)] + [(300 + k, f"{k:04d} " + "same length") for k in range(300)]
    rows += [(600, "Copy of a text"), (601, "copy OF a text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r.doc_id for r in exact.refine(docs).where("full_hash is not null").collect()}
    assert {600, 601} <= hashed and len(hashed) < 100
    want = sorted(map(str, exact.duplicates(docs, hash_all=True).collect()))
    monkeypatch.setattr(exact, "MOST_BITS", 1 << 15)  # however full the table is
    monkeypatch.setattr(exact, "BITS_PER_ROW", 1 << 15)
    monkeypatch.setattr(exact, "broadcast_if_small", lambda df, rows=0: df)
    assert {r.doc_id for r in exact.refine(docs).where("full_hash is not null").collect()} >= {600, 601}
    assert sorted(map(str, exact.duplicates(docs, hash_all=True).collect())) == want


def test_context_vectors_and_pooling_against_brute_force(spark, sf_dir, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    texts += ["", None, "one", "two words", "again again again", "x " * 3000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    units, (places, signs) = quality.Units(), quality.index_vectors()
    vectors = np.zeros((quality.ROWS, quality.DIMENSIONS))
    np.put_along_axis(vectors, places, signs.astype(float), 1)
    sums = np.zeros_like(vectors)
    for text in texts:
        rows = units(text or "").tolist()
        for i, row in enumerate(rows):
            for j in (*range(max(0, i - quality.WINDOW), i), *range(i + 1, min(len(rows), i + quality.WINDOW + 1))):
                sums[row] += vectors[rows[j]]
    want = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9) + vectors / np.sqrt(quality.NON_ZERO)
    table = quality.context_table(docs)
    assert np.abs(table - want).max() < 1e-6
    for r in quality.pooled(docs, table).collect():
        rows = units(texts[r.doc_id] or "")
        mean = want[rows].mean(axis=0) if len(rows) else np.zeros(quality.DIMENSIONS)
        assert np.abs(np.array(r.pooled) - mean).max() < 1e-5


def test_a_text_of_no_clear_language_goes(spark):
    parts = {"en": "the quick brown fox jumps over ", "de": "der schnelle braune Fuchs springt und ", "fr": "le renard saute avec élan "}
    parts |= {"es": "el zorro salta sobre la cerca ", "pt": "raposa não pula cercas então "}
    rows = [(5 * k + j, text * (k + 2), lang) for k in range(8) for j, (lang, text) in enumerate(parts.items(), 1)]
    rows += [(1000, "".join(text * 4 for text in parts.values()), None), (1001, parts["de"] * 3, None), (1002, "12 !", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    gone = {r[0] for r in rows} - {r.doc_id for r in langid.keep_identified(frame).collect()}
    assert gone == {1000, 1002}
    assert {r.lang for r in langid.keep_identified(frame, languages=["de"]).collect()} == {"de", None}


def test_stretches_of_the_schedule_hold_the_sources_in_proportion(spark):
    sizes = {"a": 300, "b": 120, "c": 400, None: 90}
    rows = [(1000 * i + k, "w " * 8, source) for i, (source, n) in enumerate(sizes.items()) for k in range(n)]
    rows += [(9000, None, "a"), (9001, "w " * 20, "b"), (9001, "w " * 20, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("slot", F.lit("x"))
    taken, planned = mixing.mix(docs, block_words=8)
    slots = {r["slot"]: r["rank"] for r in planned.slots.orderBy("slot").collect()}
    ranks = list(slots.values())
    shares = {r["rank"]: r["slots"] / len(ranks) for r in planned.sources.collect()}
    for k in range(4, 9):
        for at in range(0, len(ranks) // 2 - (1 << k), 1 << k):
            for rank, share in shares.items():
                assert abs(ranks[at : at + (1 << k)].count(rank) - share * (1 << k)) <= 2.5, (k, at, rank)
    placed = mixing.scheduled(docs, block_words=8, slot="slot").collect()
    times = {}
    for r in placed:
        times.setdefault(r.doc_id, []).append(r.slot)
    want = {r.doc_id: int(r.taken / r.size + 0.5) for r in taken.collect() if r.size}
    assert {i: len(s) for i, s in times.items() if i != 9001} == {i: n for i, n in want.items() if n and i != 9001}
    rank_of = {r["source"]: r["rank"] for r in planned.sources.collect()}
    assert all(slots[r.slot] == rank_of[r.source] for r in placed)
    ordered = mixing.in_schedule_order(docs)
    assert ordered.columns == docs.columns and {r.slot for r in ordered.collect()} == {"x"}
    assert mixing.in_schedule_order(docs.limit(0)).count() == 0


def test_the_mixing_stage_writes_stretches_of_the_schedule(spark, sf_dir, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["mixing"]
    stage(spark, docs, sf_dir).write.parquet(str(tmp_path / "mixed"))
    slots = {}
    for r in mixing.scheduled(docs).collect():
        slots.setdefault(r.doc_id, []).append(r.slot)
    ends = []
    for part in sorted((tmp_path / "mixed").glob("part-*")):
        ids = [r.doc_id for r in spark.read.parquet(str(part)).collect()]
        at = [slots[i].pop(0) if len(slots[i]) == 1 else slots[i].pop(slots[i].index(min(slots[i]))) for i in ids]
        if at:
            assert at == sorted(at)
            ends.append((at[0], at[-1]))
    assert not any(slots.values())
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_keys_that_no_other_text_has_are_left_out_before_a_join_that_shuffles(spark, monkeypatch):
    rows = spark.range(40_000).select(F.col("id").alias("fp"), F.col("id").alias("n"), F.xxhash64("id").alias("key"))
    shared = rows.where("fp % 40 = 3").select("key").localCheckpoint()
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df, rows=0: df)
    found = jaccard.of_shared(rows, shared)
    assert sorted(r.fp for r in found.collect()) == list(range(3, 40_000, 40))
    assert sorted(found.columns) == ["fp", "key", "n"]
    table, bits = exact.bit_table(shared, ["key"])
    held = exact.with_bits(rows, [F.col("key")], table, bits, "held").where("held")
    assert 1000 <= held.count() <= 1000 + 40_000 // 8
    assert jaccard.of_shared(rows, shared.limit(0)).count() == 0


def test_texts_are_shuffled_once_into_the_order_of_the_schedule(spark, monkeypatch):
    rows = [(i, f"t{i} " * (1 + i * 7 % 90), "abcd"[i % 11 % 4]) for i in range(1500)] + [(7, "t7 " * 50, "d"), (None, "x y", None)]
    docs = spark.createDataFrame([*rows, (2000, "", "a"), (2001, None, None)], "doc_id long, text string, source string")
    place = {}
    for r in mixing.scheduled(docs).collect():
        place.setdefault((r.source or "", r.doc_id or -1, r.text), []).append(r.slot)
    monkeypatch.setattr(mixing, "PART_SLOTS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ordered = mixing.in_schedule_order(docs)
        plan = ordered._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
        got = [(r.source or "", r.doc_id or -1, r.text) for r in ordered.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = sorted((slot, key[1], key) for key, slots in place.items() for slot in slots)
    assert len(want) > 1000 and sorted(got) == sorted(key for *_, key in want)
    slots = {key: sorted(slots) for key, slots in place.items()}
    at = [slots[key].pop(0) for key in got]
    assert at == sorted(at)


def test_crowded_band_values_fall_apart_without_losing_a_link(spark, monkeypatch):
    random = np.random.default_rng(4)
    centre = int(random.integers(0, 1 << 63))
    prints = {centre ^ sum(1 << int(b) for b in random.choice(40, int(random.integers(0, 9)), replace=False)) for _ in range(260)}
    prints |= {(centre & ~0x1FFF) ^ int(x) << 13 ^ (centre & 0x1FFF) for x in random.integers(0, 1 << 50, 90)}
    prints |= {int(x) for x in random.integers(0, 1 << 63, 50)}
    prints = sorted(prints)
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= simhash.MAX_BITS:
                root[top(a)] = top(b)
    want = {}
    for p in prints:
        want.setdefault(top(p), set()).add(p)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long").coalesce(2)
    for chunk, levels in ((4096, 6), (40, 6), (12, 2)):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        monkeypatch.setattr(simhash, "LEVELS", levels)
        found = simhash.links(frame)
        got = {}
        for r in simhash.components(found).collect():
            got.setdefault(r.label, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_masks_of_every_level_deal_out_all_bits():
    for level in range(1, simhash.LEVELS + 1):
        masks = simhash.finer_masks(level)
        assert len(masks) == simhash.MAX_BITS + 1 and sum(masks) == (1 << 64) - 1
        assert all(a & b == 0 for i, a in enumerate(masks) for b in masks[:i])
