"""Hard negatives, WARC archives and whitening against plain versions, on odd rows and damaged archives."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekeep.llm import negatives, warc, whitening

NAN, INF = float("nan"), float("inf")


def vectors(spark, seed=3, n=400, dims=13):
    """Ties, repeated rows and ids, nulls, odd lengths, a hot label and columns with names used inside."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(size=dims) * rng.choice([0.1, 1, 30])], int(rng.integers(0, 3)), 1) for i in range(n)]
    rows += [(i, rows[200][1], 0, 2) for i in range(n, n + 60)]
    rows += [rows[100], rows[100], (100, rows[7][1], 1, 3), (n + 100, [], 0, 1), (n + 101, [0.5], 1, 1), (500, rows[5][1], 9, 1)]
    rows += [(None, rows[1][1], 1, 1), (n + 102, None, 1, 1), (n + 103, rows[1][1], None, 1), (n + 104, [NAN, 1.0], 1, 1)]
    rows += [(n + 105, [1.0, None], 1, 1), (n + 106, [-INF], 1, 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row int")


def quantised(vector):
    return None if vector is None or any(v is None or not math.isfinite(v) for v in vector) else [math.floor(256 * v) for v in vector]


@pytest.mark.parametrize("stripes", [(8192, 256), (37, 2)])
def test_hard_negatives(spark, ws, monkeypatch, stripes):
    monkeypatch.setattr(negatives, "ROW_STRIPE", stripes[0])
    monkeypatch.setattr(negatives, "ANCHOR_STRIPE", stripes[1])
    rows, df = vectors(spark)
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, ws).collect()
    taking = [(i, quantised(v), label) for i, v, label, _ in rows]
    taking = [r for r in taking if None not in r]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    expected = collections.Counter()
    for k, (anchor, v, label) in enumerate(taking):
        if anchor % 100:
            continue
        others = [(score(v, w), i, lab) for j, (i, w, lab) in enumerate(taking) if j != k]
        order = sorted(others, key=lambda x: (-x[0], x[1]))
        for p, positive, _ in [x for x in order if x[2] == label][:5]:
            hard = [x for x in order if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p][:10]
            expected.update((anchor, positive, rank + 1, i, p, s) for rank, (s, i, _) in enumerate(hard))
    assert len(expected) > 100 and collections.Counter(map(tuple, got)) == expected


def test_scores_are_exact_for_any_width():
    rng = np.random.default_rng(1)
    for largest in (1, 2, 200, 1 << 20):
        a, b = (rng.integers(-largest, largest, (n, 19)) for n in (5, 1100))
        b[0], b[1] = -largest, largest - 1
        assert (negatives.scores(negatives.subset_tables(a), negatives.bit_planes(b)) == b @ a.T).all()
        # Vectors of other lengths count as filled up with zeros.
        assert (negatives.scores(negatives.subset_tables(a), negatives.bit_planes(b[:, :7])) == b[:, :7] @ a[:, :7].T).all()
    with pytest.raises(OverflowError):
        negatives.scores(negatives.subset_tables(np.full((1, 8), 1 << 40)), negatives.bit_planes(np.full((1, 8), 1 << 40)))


# ---- whitening


def plain_whitening(rows):
    known = [(i, quantised(v)) for i, v in rows if quantised(v) is not None]
    dims = max(len(v) for _, v in known)
    known = [(i, v + [0] * (dims - len(v))) for i, v in known]
    fit = np.array(sorted({tuple(v) for _, v in known}), float)
    n, sums = len(fit), fit.sum(0).astype(int).tolist()
    centred = fit - fit.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return known, n, sums, values[::-1], axes[:, ::-1], fit.mean(0)


def test_whitening(spark, ws):
    rows, df = vectors(spark)
    known, n, sums, values, axes, mean = plain_whitening([(i, v) for i, v, _, _ in rows])
    got = whitening.whiten(df, ws).collect()
    assert collections.Counter((r["vec_id"], r["component"]) for r in got) == collections.Counter((i, c) for i, _ in known for c in (1, 2, 3, 4))
    by_id = collections.defaultdict(list)
    for i, v in known:
        by_id[i].append(v)
    signs = {}
    for r in got:
        v = [v for v in by_id[r["vec_id"]] if sum((n * x - s) ** 2 for x, s in zip(v, sums)) == r["deviation"]]
        assert v and r["n"] == n and r["identity_error"] < 1e-10
        c = r["component"] - 1
        expected = (np.array(v[0]) - mean) @ axes[:, c] / math.sqrt(values[c])
        if abs(expected) > 1e-6:
            assert signs.setdefault(c, np.sign(expected * r["whitened"])) == np.sign(expected * r["whitened"])
        assert math.isclose(abs(r["whitened"]), abs(expected), rel_tol=1e-7, abs_tol=1e-9)
        assert math.isclose(r["explained"], values[c] / values.sum(), rel_tol=1e-9)


@pytest.mark.parametrize("spread", [1e3, 1e-6])
def test_whitening_of_dependent_and_badly_scaled_columns(spark, ws, spread):
    """Two columns that vary, one their sum, one constant, one of another order of size: three components at most."""
    rng = np.random.default_rng(4)
    a, b = rng.integers(-50, 50, (2, 300))
    x = np.column_stack([a, b, a + b, np.full(300, 7), np.where(np.arange(300) == 5, 1, 0) * (1 if spread < 1 else 10**7)])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df, ws, scale=1).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and max(r["identity_error"] for r in got) < 1e-9
    known = np.unique(x, axis=0).astype(float)
    values = np.linalg.eigvalsh(np.cov(known.T, bias=True))[::-1]
    share = {r["component"]: r["explained"] for r in got}
    assert all(math.isclose(share[c + 1], values[c] / values.sum(), rel_tol=1e-6) for c in range(3))


def test_whitening_without_variance(spark, ws):
    for rows in ([], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert whitening.whiten(df, ws).collect() == []


def test_deviations_are_exact_beyond_machine_words():
    centre = whitening.Centre(1 << 40, (3, -5), 1 << 30)
    x = np.array([[1 << 20, 7], [0, 0]])
    with pytest.raises(OverflowError):
        centre.deviation(x)
    small = whitening.Centre(1000, (3, -5), 1 << 30)
    assert small.deviation(x[1:]).tolist() == [34] and small.deviation(x).tolist() == [(1000 * (1 << 20) - 3) ** 2 + 7005**2, 34]


# ---- WARC


def some_pages():
    rng = random.Random(9)
    text = ["<p>" + " ".join(rng.choice(["a", "héllo", "WARC/1.1\r\n", "\r\n\r\n", "\x1f\u008b\x08", "x" * 50]) for _ in range(n)) for n in (0, 1, 30, 400, 9000)]
    rows = [(i, f"http://e.org/{i}", t, 1) for i, t in enumerate(text * 3)]
    rows += [(20 + i, "http://e.org/é b\r\nWARC-Type: x", "y" * n, 1) for i, n in enumerate((99, 99, 100, 100, 101))]
    rows += [(30, None, None, 1), (31, "", "", 1), (None, "http://e.org/none", text[3], 1), (None, None, "z" * 200, 1), (2, "http://again", text[2], 1), (-5, "u", text[4], 1)]
    return rows


def plain_records(rows):
    first, out = {}, []
    for page, _, html, _ in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page), page)
    for page, _, html, _ in rows:
        data = (html or "").encode()
        other = first.get(html) if first.get(html) != page else None
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if other is None else "revisit", other))
    return collections.Counter(out)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_warc_round_trip(spark, ws, broadcast):
    rows = some_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        warc.write_archives(pages, ws.path("w"), ws, archive_bytes=2000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    records, gaps = warc.read_archives(spark, ws.path("w"), ws)
    got = records.collect()
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == plain_records(rows)
    assert gaps.collect() == []
    stored = collections.Counter(bytes(r["payload"]) for r in got if r["record_type"] == "response")
    assert set(stored) == {(html or "").encode() for _, _, html, _ in rows}
    assert {r["url"] for r in got} >= {"urn:page:30", "http://e.org/é%20b%0D%0AWARC-Type:%20x", "urn:page:"}
    assert len(spark.read.format("binaryFile").load(ws.path("w")).select("path").collect()) > 3


def archive(n=12, packed=True):
    parts = []
    for i in range(n):
        payload = (f"page {i} WARC/1.1\r\n" * (5 + i)).encode()
        data = warc.page_record(i, f"http://e.org/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        parts.append(warc.member(data) if packed else data)
    return parts


def walk(data):
    records, gaps = [], []
    for found in warc.salvaged(data):
        (records if isinstance(found, warc.Record) else gaps).append(found)
    return [int(r.headers["page-id"]) for r in records], records, gaps


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_all_records_but_the_damaged(packed):
    parts = archive(packed=packed)
    begins = np.cumsum([0, *map(len, parts)]).tolist()
    whole = b"".join(parts)
    assert walk(whole)[0] == list(range(12)) and walk(whole)[2] == []
    tail = warc.EMPTY_MEMBER if packed else b""
    rng = random.Random(2)
    for _ in range(60):
        hurt = rng.randrange(12)
        at = rng.randrange(begins[hurt], begins[hurt + 1])
        flipped = bytearray(whole)
        flipped[at] ^= 1 << rng.randrange(8)
        ids, records, gaps = walk(bytes(flipped) + tail)
        # Some bits mean nothing (time and system of a gzip header, the case of a name): such a record passes its checks.
        assert set(range(12)) - {hurt} <= set(ids) and sorted(ids) == ids
        if hurt not in ids:
            assert [(a, b) for a, b, _ in gaps] == [(begins[hurt], begins[hurt + 1])]
        # A cut, and bytes that belong to no record, in the middle.
        cut = whole[:at] + whole[begins[hurt + 1] :]
        ids, records, gaps = walk(cut + tail)
        assert ids == [i for i in range(12) if i != hurt] or at == begins[hurt]
        assert [(a, b) for a, b, _ in gaps] == ([(begins[hurt], at)] if at > begins[hurt] else [])
        junk = whole[: begins[hurt]] + b"\x1f\x8b\x08junk WARC/1.1\r\nno" + whole[begins[hurt] :]
        ids, records, gaps = walk(junk)
        assert ids == list(range(12)) and [(a, b) for a, b, _ in gaps] == [(begins[hurt], begins[hurt] + 20)]
        covered = sorted({(r.start, r.end) for r in records} | {(a, b) for a, b, _ in gaps})
        assert covered[0][0] == 0 and covered[-1][1] == len(junk) and all(x[1] == y[0] for x, y in zip(covered, covered[1:]))
    for n in (0, 1, 9, len(parts[0]) - 1):
        assert walk(whole[:n]) == ([], [], [(0, n, walk(whole[:n])[2][0][2])] if n else [])


def test_salvage_of_mixed_and_foreign_archives(spark, ws, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\na: b\n\r\n\r\n"
    bad_length = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 99999\r\n\r\nshort\r\n\r\n"
    several = zlib.compressobj(6, zlib.DEFLATED, 31)
    several = several.compress(info + info) + several.flush()
    data = info + bad_length + several + archive(1)[0] + b"the end"
    (tmp_path / "odd.warc").write_bytes(data)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    records, gaps = warc.read_archives(spark, str(tmp_path), ws)
    assert sorted((r["record_type"], r["payload_bytes"]) for r in records.collect()) == [("response", 85), ("warcinfo", 5), ("warcinfo", 5), ("warcinfo", 5)]
    found = sorted((r["start"], r["end"], r["gap"]) for r in gaps.collect())
    assert found == [(len(info), len(info) + len(bad_length), "block of another length"), (len(data) - 7, len(data), "no version line")]


def test_a_page_of_many_megabytes(spark, ws):
    pages = spark.range(2).selectExpr("id as page_id", "'u' as url", "repeat('0123456789', 2000000 + cast(id as int)) as html")
    got = warc.archived(pages, ws).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(0, 20_000_000), (1, 20_000_010)]
