"""Whitening, vector codes and WARC against brute force."""

import glob
import gzip
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import vector_codes, warc, whitening
from tierline.llm.queries import QUERIES

VEC = "vec_id bigint, embedding array<float>, label int"
INF = float("inf")


def vectors(rng, n, d, spread=None):
    x = rng.normal(size=(n, d)) * (np.geomspace(0.5, 0.05, d) if spread is None else spread)
    return [(i, [float(np.float32(v)) for v in row], int(i % 3) if i % 4 else None) for i, row in enumerate(x)]


ODD = [(900, None, 1), (901, [], 1), (902, [0.1, None, 0.2, 0.3, 0.1, 0.2, 0.3, 0.4], 2), (903, [0.1, float("nan")] * 4, None),
       (904, [INF, 0.0] * 4, 1), (905, [-INF, 0.0] * 4, 1)]


def clashing(df):
    names = ("x", "i", "n", "whitened", "deviation", "code", "error", "rows", "values", "codes", "sizes", "label_error", "__g", "c0", "component")
    return df.withColumns({c: F.lit("kept") for c in names})


# -- whitening -----------------------------------------------------------------

def brute_whitening(rows, scale, k):
    """Per row: exact integer deviation; covariance by exact integer sums."""
    x = {i: [math.floor(scale * c) for c in v] for i, v, *_ in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    dev = {i: [n * c - s for c, s in zip(v, sums, strict=True)] for i, v in x.items()}
    a = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit], object)
    cov = (a.T @ a).astype(float) / float(n) ** 3
    e, vec = np.linalg.eigh(cov)
    return n, {i: sum(c * c for c in v) for i, v in dev.items()}, e[::-1], vec[:, ::-1], \
        {i: np.array(v, float) / n for i, v in dev.items()}


@pytest.mark.parametrize(("n", "d", "spread"), [(300, 8, None), (60, 3, None), (400, 8, [40.0, 4, 4, 2, 1, 0.5, 0.2, 3000.0])])
def test_whitening_matches_an_exact_covariance(spark, n, d, spread):
    rows = vectors(np.random.default_rng(n), n, d, spread)
    rows += [(1000 + i, rows[0][1], None) for i in range(n // 2)]            # a third are copies
    bad = [r for r in ODD if d == 8 or not r[1]]
    df = clashing(spark.createDataFrame(rows + bad, VEC)).repartition(5)
    model = whitening.fit_whitening(df)
    got = {r["vec_id"]: r for r in whitening.whiten(df, model).collect()}
    count, dev, e, vec, centre = brute_whitening(rows, 256, 4)
    assert set(got) == {r[0] for r in rows} and model.n == count
    assert all(got[i]["x"] == "kept" and int(got[i]["deviation"]) == dev[i] for i in got)
    k = min(4, d)
    assert np.allclose(model.explained[:k], e[:k] / e.sum(), rtol=1e-10)
    assert model.identity_error < 1e-10 and model.checked == k
    signs = np.sign([(model.components[j] @ vec[:, j]) for j in range(k)])
    for i, r in got.items():
        want = (centre[i] @ vec[:, :k]) * signs / np.sqrt(e[:k])
        assert np.allclose(r["whitened"], want, rtol=1e-7, atol=1e-8)


def test_whitening_without_full_rank_and_of_tiny_tables(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(50, 2))
    rows = [(i, [float(a), float(b), float(a), 0.25, float(b), float(a)], 0) for i, (a, b) in enumerate(base)]
    df = spark.createDataFrame(rows, VEC)
    model = whitening.fit_whitening(df)
    assert (model.eigenvalues[:2] > 0).all() and not model.eigenvalues[2:].any()
    assert model.checked == 2 and model.identity_error < 1e-9
    assert all(r["whitened"][2:] == [0.0, 0.0] for r in whitening.whiten(df, model).collect())
    one = spark.createDataFrame([(1, [0.5, -0.5], 0)] * 3, VEC)
    model = whitening.fit_whitening(one)
    assert model.n == 1 and [r["whitened"] for r in whitening.whiten(one, model).collect()] == [[0.0, 0.0]] * 3
    none = spark.createDataFrame(ODD[:2], VEC)
    model = whitening.fit_whitening(none)
    assert model.n == 0 and whitening.whiten(none, model).count() == 0
    with pytest.raises(Exception, match="different lengths"):
        whitening.fit_whitening(spark.createDataFrame([(1, [0.5], 0), (2, [0.5, 1.0], 0)], VEC).coalesce(1))


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(i, [float(np.float32(v * 1e13)), float(i)], 0) for i, v in enumerate([0.3, -2.5, 7.0])]
    df = spark.createDataFrame(rows, VEC)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df, whitening.fit_whitening(df)).collect()}
    assert got == brute_whitening(rows, 256, 2)[1] and max(got.values()) > 1 << 63


def test_shift_makes_a_singular_gram_factorable():
    a = np.ones((5, 3))
    r = whitening.shifted_cholesky(a.T @ a)
    assert np.allclose(r.T @ r, a.T @ a, atol=1e-9) and np.allclose(whitening.solve_right(a, r) @ r, a)


def test_whitening_query(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, dev, e, _, _ = brute_whitening(data, 256, 4)
    assert len(rows) == 4 * len(data) and {(r["vec_id"], r["component"]) for r in rows} == {(i, c) for i, _ in data for c in (1, 2, 3, 4)}
    assert all(r["n"] == n and r["deviation"] == dev[r["vec_id"]] and abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9
               and r["identity_error"] < 1e-9 for r in rows)


# -- vector codes ----------------------------------------------------------------

def brute_codes(rows, parts, entries, rounds, scale):
    x = [(i, [math.floor(scale * c) for c in v], g) for i, v, g in rows]
    order = sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(x[0][1]) // parts
    books = [[v[p * w:(p + 1) * w] for _, v, _ in order[:entries]] for p in range(parts)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in x:
                part = v[p * w:(p + 1) * w]
                groups.setdefault(nearest(part, books[p])[0], []).append(part)
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else old for e, old in enumerate(books[p])]
    out = []
    for i, v, g in x:
        got = [nearest(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, [e for e, _ in got], sum(d for _, d in got), g))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return out, digest


@pytest.mark.parametrize("big", [1.0, 2e5])
def test_codes_match_brute_force(spark, big):
    rng = np.random.default_rng(8)
    rows = [(i, [v * big for v in vec], g) for i, vec, g in vectors(rng, 150, 8, np.full(8, 0.2))]
    rows = [(i, [float(np.float32(v)) for v in vec], g) for i, vec, g in rows]
    rows += [(500 + i, rows[3][1], 7) for i in range(70)] + [(2, rows[5][1], 1), (None, rows[6][1], None)]
    df = clashing(spark.createDataFrame(rows + ODD, VEC)).repartition(7)
    coded, books = vector_codes.compress(df, parts=4, entries=6, rounds=4)
    want, digest = brute_codes(rows, 4, 6, 4, 4096)
    got = vector_codes.with_group_sum(coded, "label", "error", "label_error").collect()
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2])
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=key) == sorted(((i, c, e) for i, c, e, _ in want), key=key)
    assert books.digest() == digest and all(r["x"] == "kept" and r["rows"] == "kept" for r in got)
    sums = {}
    for _, _, e, g in want:
        sums[g] = sums.get(g, 0) + e
    assert all(r["label_error"] == sums[r["label"]] for r in got)


def test_group_sums_of_many_groups_are_salted(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FEW_GROUPS", 2)
    df = spark.createDataFrame([(i, i % 5 if i % 3 else None, i) for i in range(300)], "id int, label int, error bigint")
    got = vector_codes.with_group_sum(df, "label", "error", "s").collect()
    want = {}
    for i in range(300):
        g = i % 5 if i % 3 else None
        want[g] = want.get(g, 0) + i
    assert len(got) == 300 and all(r["s"] == want[r["label"]] for r in got)


def test_codes_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(2, [1.0, 2.0], None), (1, [3.0, 4.0], 5)], VEC)
    coded, books = vector_codes.compress(few, parts=2, entries=16)
    assert books.entries.shape == (2, 2) and {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()} == {1: ([0, 0], 0), 2: ([1, 1], 0)}
    coded, books = vector_codes.compress(spark.createDataFrame(ODD, VEC))
    assert coded.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()
    assert vector_codes.with_group_sum(coded, "label", "error", "s").count() == 0
    far = spark.createDataFrame([(1, [0.0, 1e9], 0), (2, [1e9, 0.0], 0), (3, [0.0, 0.0], 1)], VEC)
    coded, _ = vector_codes.compress(far, parts=1, entries=1, rounds=0)
    got = {r["vec_id"]: (r["error"], r["s"]) for r in vector_codes.with_group_sum(coded, "label", "error", "s").collect()}
    assert got == {1: (0, None), 2: (None, None), 3: (None, None)}          # 2 * (4096e9)^2 is beyond a long
    with pytest.raises(ValueError, match="do not divide"):
        vector_codes.compress(few, parts=3)


# -- WARC --------------------------------------------------------------------------

PAGE = "page_id bigint, url string, html string"
LONG = "<p>" + "same text " * 30
TRICKY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nxxxxx\r\n\r\n"
PAGES = [(1, "http://a.example/x y?q=1#f", LONG), (2, "https://b.example", LONG), (3, None, LONG), (7, "http://c.example/\r\nX: y", TRICKY * 3),
         (5, "http://c.example/", TRICKY * 3), (6, "http://d.example/", None), (8, "http://d.example/", ""), (9, "http://e.example/é", "short"),
         (10, "http://e.example/", "short"), (1, "http://a.example/x y?q=1#f", LONG), (None, "no scheme", LONG), (None, None, "only null ids " * 20),
         (None, "u", "only null ids " * 20), (11, "http://f.example/", "é" * 60 + "\r\n"), (12, "http://f.example/", "é" * 60 + "\r\n"),
         (13, "http://g.example/", "x" * 300_000), (14, "http://g.example/", "x" * 300_000), (15, "http://h.example/", "\r\n" * 70)]


def want_warc(pages):
    """(id, bytes, digest, type, refers_to) of each page."""
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        to = first.get(h or "")
        again = len(b) >= 100 and to is not None and to != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", to if again else None))
    return out


def plain_warc(folder):
    """The archives by a plain reader: (headers, block) of each record."""
    out = []
    for f in glob.glob(f"{folder}/*.txt.gz"):
        data = gzip.open(f).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            assert len(fields) == len(lines) - 1
            n = int(fields["Content-Length"])
            assert rest[n:n + 4] == b"\r\n\r\n"
            out.append((fields, rest[:n]))
            data = rest[n + 4:]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


def test_archives_round_trip(spark, tmp_dir):
    path = f"{tmp_dir}/warc"
    pages = spark.createDataFrame(PAGES, PAGE).withColumns({"id": F.lit(1), "digest": F.lit(2), "r_id": F.lit(3)}).repartition(3)
    warc.write_warc(pages, path, date="2024-01-01T00:00:00Z")
    plain = plain_warc(path)
    assert len(plain) == 3 * len(PAGES) == len({f["WARC-Record-ID"] for f, _ in plain})
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    got = [(int(r["metadata"]["fields"]["page-id"]) if r["metadata"]["fields"] else None, r["response"]["payload_bytes"],
            r["response"]["payload_digest"], r["response"]["type"]) for r in captures]
    assert order(got) == order([w[:4] for w in want_warc(PAGES)])
    texts = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in captures:
        assert r["request"]["type"] == "request" and r["request"]["concurrent_to"] == [r["capture_id"]]
        assert r["response"]["date"] == "2024-01-01T00:00:00Z" and r["response"]["http_status"] == 200
        if r["response"]["type"] == "response":
            i = r["metadata"]["fields"].get("page-id")
            assert i is None or bytes(r["response"]["payload"]) == texts[int(i)]
        else:
            assert r["response"]["payload"] is None and r["response"]["profile"] == warc.PROFILE
    kept = {f["WARC-Record-ID"]: b for f, b in plain if f["WARC-Type"] == "response"}
    assert all(kept[r["capture_id"]].endswith(bytes(r["response"]["payload"])) for r in captures if r["response"]["type"] == "response")
    uri = {r["response"]["target_uri"] for r in captures}
    assert "http://a.example/x%20y?q=1#f" in uri and "http://c.example/%0D%0AX:%20y" in uri and None in uri


def test_foreign_archives(spark, tmp_dir):
    """Links from the response, records of no capture, bytes that are no text,
    several gzip members, and a truncated archive."""
    def rec(kind, rid, block, *more):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"Content-Length: {len(block)}", *more])
        return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    body = bytes(range(256)) * 3
    http = b"HTTP/1.1 404 Not Found\r\nX-A: b\r\n\r\n" + body
    kind = "Content-Type: application/http"
    data = rec("warcinfo", "<i>", b"software: x\r\n", "Content-Type: application/warc-fields") + rec("request", "<q>", b"GET / HTTP/1.1\r\n\r\n", kind) \
        + rec("response", "<r>", http, kind, "WARC-Concurrent-To: <q>", "WARC-Concurrent-To: <z>") \
        + rec("metadata", "<m>", b"a: 1\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <r>") \
        + rec("metadata", "<n>", b"a: 2\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <r>") \
        + rec("metadata", "<lost>", b"a: 3\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <none>")
    open(f"{tmp_dir}/a.warc.gz", "wb").write(data)
    (one,) = warc.assemble(warc.read_records(spark, f"{tmp_dir}/a.warc.gz")).collect()
    assert one["capture_id"] == "<r>" and one["request"]["record_id"] == "<q>" and one["metadata"]["fields"] == {"a": "1"}
    assert one["response"]["http_status"] == 404 and bytes(one["response"]["payload"]) == body and one["response"]["http_headers"] == {"x-a": "b"}
    assert warc.read_records(spark, f"{tmp_dir}/a.warc.gz", payload=False).filter("payload is not null").count() == 0
    open(f"{tmp_dir}/b.warc.gz", "wb").write(gzip.compress(gzip.decompress(data)[:-60]))
    with pytest.raises(Exception, match="truncated"):
        warc.read_records(spark, f"{tmp_dir}/b.warc.gz").collect()


def test_empty_archives(spark, tmp_dir):
    warc.write_warc(spark.createDataFrame([], PAGE), f"{tmp_dir}/none")
    assert warc.assemble(warc.read_records(spark, f"{tmp_dir}/none")).count() == 0


def test_warc_query_on_odd_pages(spark, tmp_dir):
    spark.createDataFrame(PAGES, PAGE).repartition(2).write.parquet(f"{tmp_dir}/pages.parquet")
    got = [tuple(r) for r in QUERIES["op12_warc"](spark, tmp_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert order(got) == order(want_warc(PAGES))
