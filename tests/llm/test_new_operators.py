"""Whitening, the prefix trie and the archives against brute force, edge rows among them."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from claimloom.llm import trie, warc, whitening
from claimloom.llm.catalog import QUERIES

# --- whitening


def plain_whitening(vectors, components=32):
    whole = [np.array(v, float) for v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array(whole)).astype(object) + 1_000_000
    n, sums = len(x), sum(x)
    deviations = [int(sum((n * row - sums) ** 2)) for row in x]
    centred = np.array([[float((n * a - s)) / n for a, s in zip(row, sums)] for row in x])
    _, scale, basis = np.linalg.svd(centred / np.sqrt(n), full_matrices=True)
    scale = np.concatenate([scale, np.zeros(len(basis) - len(scale))])[: len(basis)]
    live = scale > 1e-9 * max(scale[0], 1e-300)
    with np.errstate(all="ignore"):
        white = np.where(live, centred @ basis.T / scale, np.nan)[:, :components]
    return n, deviations, white, (scale**2 / max((scale**2).sum(), 1e-300))[:components]


def check_whitening(rows, vectors):
    n, deviations, white, shares = plain_whitening(vectors)
    wide = white.shape[1]
    assert len(rows) == n * wide
    got = np.array([np.nan if r.whitened is None else r.whitened for r in rows]).reshape(n, wide)
    assert [r.component for r in rows[:wide]] == list(range(1, wide + 1))
    assert {r.n for r in rows} == {n}
    assert [r.deviation for r in rows[::wide]] == [d if d < 1 << 63 else None for d in deviations]
    assert np.allclose([r.explained for r in rows[:wide]], shares, rtol=1e-9, atol=1e-12)
    assert (np.isnan(got) == np.isnan(white)).all()
    assert all(r.identity_error < 1e-9 for r in rows)
    return got, white


def test_whitening_query_against_svd(spark, sf_dir):
    rows = QUERIES["op11_whitening"](spark, sf_dir).collect()
    vectors = [r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, white = check_whitening(rows, vectors)
    for k in range(got.shape[1]):
        assert min(np.abs(got[:, k] - white[:, k]).max(), np.abs(got[:, k] + white[:, k]).max()) < 1e-8


EDGES = [
    (1, [0.5, 1.0, 2.0, -1.0]), (2, [0.5, 1.5, 1.0, -1.0]), (3, None), (4, [0.5, None, 1.0, 2.0]), (5, []),
    (6, [0.5, float("nan"), 1.0, 2.0]), (7, [0.5, float("inf"), 1.0, 2.0]), (None, [0.5, 2.0, 7.0, -1.0]),
    (2, [0.5, 1.5, 1.0, -1.0]), (8, [0.5, -3.0, 2.0, -1.0]), (9, [1e6, 2e6]),
]


def test_whitening_of_edge_rows_has_two_components_without_variance(spark):
    schema = "vec_id long, embedding array<float>, component string, whitened string, n string"
    df = spark.createDataFrame([(*row, "x", "y", "z") for row in EDGES], schema).coalesce(1)
    rows = whitening.whiten(df).collect()
    kept = [v for i, v in EDGES if i != 9]
    got, white = check_whitening(rows, kept)
    assert np.isnan(got[:, 2:]).all() and not np.isnan(got[:, :2]).any()
    model = whitening.fit(df)
    out = whitening.transform(df, model, whitened="whitened", deviation="deviation")
    assert out.columns == ["vec_id", "embedding", "component", "n", "whitened", "deviation"]
    assert out.count() == 5
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 3")).count() == 0
    alone = whitening.whiten(df.where("vec_id = 1")).collect()
    assert len(alone) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 for r in alone)


def test_whitening_keeps_small_components(spark):
    random = np.random.default_rng(5)
    turned = np.linalg.qr(random.normal(size=(12, 12)))[0]
    x = random.normal(size=(400, 12)) * np.logspace(7, 1, 12) @ turned
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df.coalesce(2)).collect()
    got, white = check_whitening(rows, x.tolist())
    assert got.shape == (400, 12)
    assert whitening.fit(df).passes >= 2


def test_substitution_solves_upper_triangles():
    random = np.random.default_rng(1)
    upper = np.triu(random.normal(size=(70, 70))) + 9 * np.eye(70)
    rows = random.normal(size=(5, 70))
    assert np.allclose(whitening.solve_upper(rows, upper) @ upper, rows)


# --- prefix trie


def plain_trie(turns):
    convs = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append((turn is not None, turn or 0, name, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(rows)] for c, rows in convs.items()}
    built = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + rows[h:]
    members = {}
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(c)
    out = {}
    for prefix in sorted(members, key=len, reverse=True):
        kids = [out[p] for p in members if len(p) == len(prefix) + 1 and p[:-1] == prefix] if len(members) < 3000 else None
        ids = sorted(members[prefix])
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(prefix))
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        out[prefix] = [
            ids[0], len(prefix), min(members[prefix[:-1]]) if prefix else None, len(ids), len(kids),
            sum(k[5] for k in kids) or 1, (len(ids) - 1) * words + sum(k[6] for k in kids), hashlib.sha256(ends.encode()).hexdigest(),
        ]
    return Counter(map(tuple, out.values()))


SCHEMA = "conv_id long, turn long, role string, text string, depth string, name string, top string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", "y", "z") for t in turns], SCHEMA)


TURNS = [
    (0, 0, "user", "a b c"), (0, 1, "bot", "d"), (0, 2, "user", "e e e"), (0, 3, "bot", "end"),
    (1, 0, "user", "a b c"), (1, 1, "bot", "d"), (1, 5, "user", "other"), (2, None, "user", "first"), (2, 0, "user", None),
    (2, 0, None, "tie"), (2, 0, None, "tie"), (2, 0, "bot", "tie"), (3, 0, "user", "a b c"), (None, 0, "user", "lost"),
    (20, 0, "user", ""), (21, 0, "user", "a b c"), (22, 0, "user", "long " * 30_000), (43, 7, "user", "absent origin"),
    (44, 7, "user", "absent origin"), (45, 7, "user", "absent origin"), (46, 7, "user", "absent origin"), (-7, 1, "us", "er"),
    (40, 0, "use", "rx"), (60, 0, "user", "x"), *[(61, k % 70, "user", f"turn {k // 3}") for k in range(150)],
    *[(62, k % 70, "user", f"turn {k // 3}") for k in range(75)],
]


def test_trie_of_edge_conversations(spark):
    turns = [t for t in TURNS if t[0] != -7]
    got = Counter(map(tuple, trie.prefix_trie(frame(spark, turns)).collect()))
    assert got == plain_trie(turns)
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    ids = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][:3]
    turns = [(c, 0, "user", "only") for c in ids]
    rows = trie.prefix_trie(frame(spark, turns)).collect()
    ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert [tuple(r) for r in rows] == [(ids[0], 0, None, 3, 0, 1, 0, ends)]


def test_trie_with_small_ranges_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "ROWS_PER_RANGE", 7)
    monkeypatch.setattr(trie, "PIECE_IDS", 2)
    turns = [(c, k, "user", f"{k} {c % 3 if k > 4 else ''}") for c in range(60) for k in range(c % 9)]
    monkeypatch.setattr(trie, "broadcast_if_small", lambda df, rows=0: df)
    assert Counter(map(tuple, trie.prefix_trie(frame(spark, turns)).collect())) == plain_trie(turns)


def test_trie_query(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    df = QUERIES["op12_prefix_trie"](spark, sf_dir)
    assert {t for c, t in df.dtypes if c != "ends_sha256"} == {"bigint"}
    assert Counter(map(tuple, df.collect())) == plain_trie(turns)


# --- archives


def test_archives_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    want = {}
    last = {}
    for p in pages:
        payload = (p.html or "").encode()
        want[p.page_id] = (len(payload), hashlib.sha1(payload).hexdigest())
        last[want[p.page_id]] = max(last.get(want[p.page_id], p.page_id), p.page_id)
    for r in QUERIES["op13_warc"](spark, sf_dir).collect():
        size, digest = want.pop(r.page_id)
        revisit = size >= 1000 and last[size, digest] != r.page_id
        assert (r.payload_bytes, r.payload_digest) == (size, digest)
        assert (r.record_type, r.refers_to) == (("revisit", last[size, digest]) if revisit else ("response", None))
    assert not want


FAKE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n"
PAGES = [
    (1, "u", None), (2, None, ""), (3, "a b\r\nc", FAKE * 60), (4, "u", FAKE * 60), (None, "u", FAKE * 60),
    (None, "u", "y" * 1200), (5, "u", "ä漢" * 3000), (5, "u", "ä漢" * 3000), (6, "u", "ä漢" * 3000), (6, "v", "ä漢" * 3000),
    (7, "u", "z" * 999), (8, "u", "z" * 999), (8, "u", "z" * 999), (9, "u", "\r\n" * 5000 + "\r\n\r\nWARC/" * 300),
    (10, "u", "L" * 3_000_000), (11, "u", "z" * 1000), (12, "u", "z" * 1000),
]


@pytest.mark.parametrize("small", [True, False])
def test_archives_round_trip_of_edge_pages(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(warc, "broadcast_if_small", lambda df, rows=0: df)
    schema = "page_id long, url string, html string, digest string, payload string, part string"
    df = spark.createDataFrame([(*p, "a", "b", "c") for p in PAGES], schema).repartition(3)
    rows = warc.round_trip(df).collect()
    assert {r.fault for r in rows} == {None}
    largest = {}
    for i, _, html in PAGES:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, html in PAGES:
        payload = (html or "").encode()
        again = len(payload) >= 1000 and largest[html] != (-1 if i is None else i)
        name = None if i is None else str(i)
        want[name, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response",
             str(largest[html]) if again else None] += 1
    assert Counter((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    assert warc.round_trip(df.limit(0)).count() == 0


def archive(spark, tmp_path, data):
    (tmp_path / "x.warc").write_bytes(data)
    return {r.record_id: r for r in warc.read(spark, str(tmp_path)).collect()}


def test_faults_are_told_one_by_one(spark, tmp_path):
    sha = hashlib.sha1(b"p" * 50).hexdigest()

    def page(name):
        return list(warc.page_records(name, "http://u", b"p" * 50, sha, segment_bytes=40))

    whole, absent, short, framing, digest = (page(x) for x in ("whole", "absent", "short", "framing", "digest"))
    assert len(whole) == 4
    del absent[1]
    short[-1] = re.sub(rb"Total-Length: \d+", b"Total-Length: 7", short[-1])
    framing[2] = framing[2].replace(b"32\r\n", b"zz\r\n")
    digest[2] = digest[2].replace(b"ppp", b"qqq", 1)
    records = [*whole[::-1], whole[1], *absent, *short, *framing, *digest, b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nzzz"]
    rows = archive(spark, tmp_path, b"".join(r + b"\r\n\r\n" for r in [*records, *page("after")]) + page("cut")[0][:-5])
    assert rows["whole"].fault is None and bytes(rows["whole"].payload) == b"p" * 50
    assert rows["after"].fault is None and rows["after"].payload_bytes == 50
    assert rows["absent"].fault == warc.SEGMENTS and rows["short"].fault == warc.LENGTH
    assert rows["digest"].fault == warc.DIGEST and rows["cut"].fault == warc.SEGMENTS
    assert rows["framing"].fault == warc.FRAMING
    assert rows[""].fault is not None


def test_revisits_of_absent_records_have_a_fault(spark, tmp_path):
    sha = hashlib.sha1(b"x").hexdigest()
    (tmp_path / "x.warc").write_bytes(next(warc.page_records("1", None, b"", sha, revisit_of=("2",))) + b"\r\n\r\n")
    (row,) = warc.resolved(warc.read(spark, str(tmp_path))).collect()
    assert (row.fault, row.payload_bytes, row.refers_to) == (warc.TARGET, None, "2")


def test_chunks():
    for n in (0, 1, 1024, 5000):
        assert warc.unchunked(warc.chunked(b"a" * n)) == b"a" * n
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"3\r\nabc\r\n0\r\n"):
        assert warc.unchunked(broken) is None
