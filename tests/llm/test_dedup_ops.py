"""SimHash, syncmers, suffix index, packing and the pipeline against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.llm import packing, simhash, suffix_index, syncmer
from tierline.llm.components import components

DOC = "doc_id bigint, text string"
ODD = [(1, None), (2, ""), (3, " \t\n "), (None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (5, "long words here " * 9000),
       (6, "x"), (7, "é ñ ü\nß")]


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOC)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("row", "k_id", "k_h", "marks", "spans", "fp", "h", "part", "rank", "uid", "core")})
    return df


# -- components ---------------------------------------------------------------

def brute_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_hubs_and_noise(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [
        (rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (-5, -3), (-3, -5)]
    want = brute_components({x for e in edges for x in e}, edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: r for n, r in want.items() if n != 7 or r != 7}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- SimHash ------------------------------------------------------------------

def brute_fp(text, k=4):
    import re
    import xxhash
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB é\t\nİ\x1c z", max_size=60))
def test_fingerprint_matches_brute_force(text):
    assert simhash.simhash(text, 4) == brute_fp(text)


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(list(range(64)), 4)
    rng = random.Random(4)
    assert len(masks) == 31
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not diff & m for m in masks)


def near_classes(fps, radius=4):
    fps = sorted(set(fps))
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= radius]
    return brute_components(fps, edges)


def linked(spark, fps):
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in set(fps)]
    e = simhash.links(spark.createDataFrame(signed, "fp bigint"), 4)
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in e.collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    return brute_components(sorted(set(fps)), pairs)


def test_links_lose_none(spark):
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(200)]
    for x in list(fps[:60]):
        for _ in range(rng.randint(1, 4)):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.append(x)
    assert linked(spark, fps) == near_classes(fps)


def test_large_buckets_are_refined_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY", 5)            # a few members make a bucket large
    monkeypatch.setattr(simhash, "SAMPLE", 2)
    rng = random.Random(8)
    base = rng.getrandbits(64)
    fps = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 12))) for _ in range(250)]
    assert linked(spark, fps) == near_classes(fps)


def test_near_duplicates_odd_inputs_and_keep_first(spark):
    got = simhash.near_duplicates(frame(spark, ODD, extra=True)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert {by[i]["component_id"] for i in (1, 2, 3)} == {1} and by[1]["fingerprint"] == "0" * 16
    assert by[None]["component_id"] == by[4]["component_id"] == 4
    kept = simhash.keep_first(frame(spark, ODD, extra=True))
    assert set(kept.columns) == set(frame(spark, ODD, extra=True).columns)
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect())
    assert len(ids) == len(set(ids)) == len({r["component_id"] for r in got}) and ids[0] == 1 and 4 in ids
    assert simhash.near_duplicates(frame(spark, [])).count() == 0 and simhash.keep_first(frame(spark, [])).count() == 0


# -- syncmers -----------------------------------------------------------------

def test_syncmers_are_context_free():
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ij") for _ in range(400))
    a, b = "x" * 37 + passage + "tail" * 9, passage[:]
    pa, ha = syncmer.anchors(syncmer.codes_of(a))
    pb, hb = syncmer.anchors(syncmer.codes_of(b))
    assert {(p + 37, h) for p, h in zip(pb.tolist(), hb.tolist())} <= set(zip(pa.tolist(), ha.tolist()))


def test_syncmers_match_their_definition():
    rng = random.Random(5)
    codes = syncmer.codes_of("".join(rng.choice("abcd é") for _ in range(200)))
    k, s = syncmer.K, syncmer.S
    inner = syncmer._windows(codes, s)
    want = [i for i in range(len(codes) - k + 1) if inner[i:i + k - s + 1].min() in (inner[i], inner[i + k - s])]
    assert syncmer.anchors(codes)[0].tolist() == want


def test_fingerprints_keep_the_anchors_of_any_passage():
    """A passage planted in a long text is seen in the likeness, and every
    anchor of the passage is in the fingerprint of the whole."""
    rng = random.Random(3)

    def text(n):
        return "".join(rng.choice("abcdefgh ijklm") for _ in range(n))

    for _ in range(30):
        a, b = text(6000), text(6000)
        passage = a[2000:2500]
        prints = [syncmer.sketch(syncmer.codes_of(x)) for x in (a, b, b[:3000] + passage + b[3500:], passage)]
        assert set(prints[3].tolist()) <= set(prints[0].tolist()) & set(prints[2].tolist())
        assert syncmer.likeness(prints[0], prints[2]) > syncmer.likeness(prints[0], prints[1])


def test_compare_with_next_matches_brute_force(spark):
    rng = random.Random(9)
    rows = [(i * 3 % 101, "".join(rng.choice("abcdefg é") for _ in range(rng.choice([0, 1, 7, 300])))) for i in range(101)]
    got = {r["doc_id"]: r for r in syncmer.compare_with_next(frame(spark, rows).repartition(7)).collect()}
    order = sorted(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        n = len(t)
        edited = t[:n - n // 2] + nxt[:n // 2]
        own, ed = (syncmer.sketch(syncmer.codes_of(x)) for x in (t, edited))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (syncmer.fingerprint_string(own), syncmer.fingerprint_string(ed))
        assert r["near_edited"] == syncmer.likeness(own, ed)
        assert r["near_next"] == syncmer.likeness(own, syncmer.sketch(syncmer.codes_of(nxt)))


def test_compare_odd_inputs(spark):
    out = syncmer.compare_with_next(frame(spark, ODD, extra=True)).collect()
    assert len(out) == len(ODD) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    one = syncmer.compare_with_next(frame(spark, [(1, "only one document here")])).first()
    assert one["near_next"] == 1.0
    assert syncmer.compare_with_next(frame(spark, [])).count() == 0
    prints = syncmer.fingerprint_docs(frame(spark, ODD)).collect()
    assert len({r["fingerprint"] for r in prints if r["doc_id"] in (None, 4)}) == 1


# -- suffix index -------------------------------------------------------------

def brute_cut(texts, w):
    seen = Counter(b[i:i + w] for b in texts for i in range(len(b) - w + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - w + 1):
            if seen[b[i:i + w]] > 1:
                gone[i:i + w] = True
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
                    bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shared_rows(n=80):
    rng = random.Random(7)
    word = ["alpha", "beta", "γδ", "epsilon", "zeta ", "é"]
    pool = ["".join(rng.choice(word) + " " for _ in range(60)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = ["".join(rng.choice(word) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 20)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(pool)
            a = rng.randint(0, 100)
            parts.append(p[a:a + rng.randint(10, 200)] + str(rng.random()))
        rows.append((i, "".join(parts)))
    return rows + [(n, "ab" * 150), (n + 1, "z" * 90), (n + 2, rows[3][1]), (n + 3, None), (n + 4, "")]


def check_cut(spark, rows, **opts):
    got = {r["doc_id"]: r for r in suffix_index.remove_repeats(frame(spark, rows), **opts).collect()}
    for (i, _), want in zip(rows, brute_cut([(t or "").encode() for _, t in rows], opts["min_match"])):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want, i


def test_suffix_dedup_matches_brute_force(spark):
    check_cut(spark, shared_rows(), min_match=64)


def test_suffix_dedup_more_batches_and_levels(spark):
    index = suffix_index.SuffixIndex()
    keyed = frame(spark, shared_rows()).select(F.col("doc_id").alias("k_id"), F.xxhash64("text").alias("k_h"), "text")
    for i in range(5):
        index.add(suffix_index.suffixes(keyed.filter(f"k_id % 5 = {i}"), "text", 64, 33, places=False))
    assert [n for n, _ in index.levels] == [4, 1]
    check_cut(spark, shared_rows(), min_match=64, batches=3)


def test_suffix_index_scans_each_batch_against_the_levels(spark):
    """``add`` reports the cores that the batch shares with earlier batches, or
    holds twice, by a brute-force count."""
    rng = random.Random(9)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(4)]
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(90))
    batches = [[(10 * b + i, noise() + shared[(b + i) % 4] * (i % 2 + (b == 3)) + noise()) for i in range(4)] for b in range(6)]
    index, seen = suffix_index.SuffixIndex(4), {}
    for rows in batches:
        keyed = frame(spark, rows).selectExpr("doc_id as k_id", "xxhash64(text) as k_h", "text")
        batch = suffix_index.suffixes(keyed, "text", 64, 33, places=False)
        mine = Counter()
        for r in batch.collect():
            mine[r["core"]] += r["n"]
        want = {c for c, n in mine.items() if n > 1 or c in seen}
        assert {r["core"] for r in index.add(batch).collect()} == want
        seen.update(mine)
    assert [n for n, _ in index.levels] == [4, 2] and len(index.matches) == 6


def test_suffix_groups_do_not_grow_with_the_tasks(spark, monkeypatch):
    """Three rare contexts of a core and one that most documents have."""
    rng = random.Random(4)
    common = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, ("x%d" % (i % 3) * 20 if i < 3 else "a common line ") + common + ("y%d" % i * 20 if i < 3 else " and its end")) for i in range(256)]
    sizes = {}
    for tasks in (4, 32):
        seen = []
        real = suffix_index.members
        monkeypatch.setattr(suffix_index, "members", lambda runs, real=real, seen=seen: seen.append(real(runs)) or seen[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
        try:
            suffix_index.remove_repeats(frame(spark, rows), min_match=64)
            sizes[tasks] = max(len(r["members"]) for r in seen[0].collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
            monkeypatch.undo()
    assert sizes[4] == sizes[32] <= 8


def test_suffix_dedup_wide_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_index, "WIDE", 1)         # every group by the string counts
    check_cut(spark, shared_rows(), min_match=64)


def test_suffix_dedup_long_text_in_stretches(spark):
    old = suffix_index.CHUNK
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij ") for _ in range(40000))
    out = list(suffix_index._pieces(np.array([0, old * 2 + 5, old * 2 + 9]), 64))
    assert [(a, b) for a, b, *_ in out] == [(0, old + 63), (old, 2 * old + 5), (2 * old, 2 * old + 5), (2 * old + 5, 2 * old + 9)]
    check_cut(spark, [(1, text), (2, "start " + text[20000:30000] + " end")], min_match=400)


def test_suffix_scan_holds_little_at_a_time(monkeypatch):
    """What a Python worker holds beside a batch, whatever the batch's size."""
    import tracemalloc
    monkeypatch.setattr(suffix_index, "_CACHE", {})
    data = np.random.default_rng(1).integers(97, 123, 6_000_000, dtype=np.uint8)
    offsets = np.concatenate([np.arange(0, 3_000_000, 2000), [3_000_000, 6_000_000]])
    tracemalloc.start()
    places = sum(len(suffix_index.chosen_places(data[lo:hi], starts, ends, 200, 128)[0])
                 for lo, hi, _, starts, ends in suffix_index._pieces(offsets, 200))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert places > 50_000 and peak < 40e6, peak


def test_suffix_dedup_odd_inputs(spark):
    out = suffix_index.remove_repeats(frame(spark, ODD, extra=True), min_match=40)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(ODD) and rows[1]["n_bytes"] == 0 and rows[5]["n_removed"] == len("long words here ") * 9000
    assert rows[4]["row"] == "x" and rows[4]["marks"] == "x"
    assert suffix_index.remove_repeats(frame(spark, []), min_match=40).count() == 0


def test_likeness_against_the_longest_common_order():
    rng = random.Random(8)
    for _ in range(60):
        a, b = (np.array(rng.sample(range(25), rng.randint(0, 14)), np.uint32) for _ in range(2))
        place = {int(x): i for i, x in enumerate(b)}
        order = [place[int(x)] for x in a if int(x) in place]
        longest = [0] * len(order)
        for i, x in enumerate(order):
            longest[i] = 1 + max((longest[j] for j in range(i) if order[j] < x), default=0)
        both = len(order)
        want = 1.0 if not len(a) and not len(b) else max(longest, default=0) / (len(a) + len(b) - both) if len(a) and len(b) else 0.0
        assert syncmer.likeness(a, b) == want


# -- packing ------------------------------------------------------------------

def brute_best_fit(lengths, sizes, cost, largest):
    """Piece by piece: decreasing lengths into the fullest bin that has room,
    as many equal ones as fit before another bin is looked for."""
    bins, left = [], Counter(lengths)
    short = {ln: ln * c for ln, c in left.items()}
    for ln in sorted(left, reverse=True):
        while left[ln]:
            open_ = [b for b in bins if b["free"] >= ln]
            if open_:
                b = min(open_, key=lambda b: b["free"])
            else:
                ok = [s for s in sizes if s >= ln and (s <= largest or s == min(x for x in sizes if x >= ln))]

                def unit(s):
                    q = min(left[ln], s // ln)
                    rest = s - q * ln
                    more = sum(v for k, v in short.items() if k <= min(rest, ln - 1)) if rest else 0
                    return cost(s) / (q * ln + min(rest, more / -(-left[ln] // q)))

                size = min(ok, key=lambda s: (unit(s), s))
                for _ in range(-(-left[ln] // (size // ln))):        # a run of equal bins is opened at once
                    bins.append({"size": size, "free": size})
                continue
            q = min(b["free"] // ln, left[ln])
            b["free"] -= q * ln
            left[ln] -= q
    return bins


def test_plan_is_best_fit_piece_by_piece():
    rng = random.Random(11)
    sizes = [16, 32, 64]
    for _ in range(30):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 80))]
        totals = []
        for m in sizes:
            bins = brute_best_fit(lengths, sizes, packing.default_cost, m)
            totals.append(sum(packing.default_cost(min(s for s in sizes if s >= b["size"] - b["free"])) for b in bins))
        plan = packing.plan_bins(dict(Counter(lengths)), sizes)
        used = {}
        for r in plan.itertuples():
            for k in range(r.count):
                used.setdefault(r.bin + k // r.per_bin, r.size)
        assert sum(packing.default_cost(s) for s in used.values()) == min(totals)


def check_packed(rows, sizes):
    bins = {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
    assert sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        b.sort(key=lambda r: r["bin_offset"])
        assert b[0]["bin_offset"] == 0 and len({r["bin_size"] for r in b}) == 1
        assert all(x["bin_offset"] + x["n_places"] == y["bin_offset"] for x, y in zip(b, b[1:]))
        used = b[-1]["bin_offset"] + b[-1]["n_places"]
        assert b[0]["bin_size"] == min(s for s in sizes if s >= used)      # downsized


def test_packing_places_every_piece_once(spark):
    rng = random.Random(12)
    rows = [(i, "w " * rng.choice([0, 3, 3, 3, 10, 40, 150])) for i in range(300)] + ODD
    got = packing.pack(frame(spark, rows, extra=True), sizes=(16, 32, 64)).collect()
    check_packed(got, (16, 32, 64))
    want = Counter()
    for i, t in rows:
        want[i] += len((t or "").split()) + 1
    have = Counter()
    for r in got:
        have[r["doc_id"]] += r["n_places"]
    assert have == want
    assert packing.pack(frame(spark, [])).count() == 0


# -- pipeline -----------------------------------------------------------------

def test_pipeline_stages_keep_the_columns_and_compose(spark):
    import corpus_pipeline as p
    d = "/root/testdata/sf0.001"
    start = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    frames, now = [], start
    for _, stage in p.STAGES:
        now = stage(spark, now, d).checkpoint()
        frames.append(now)
    for f in frames[:-1]:
        assert [(c.name, c.dataType) for c in f.schema] == [(c.name, c.dataType) for c in start.schema]
    lang, lines, near, cut, bins = (f.collect() for f in frames)
    assert len(lang) == start.filter("text rlike '[a-zA-Z]'").count()
    fps = near_classes([brute_fp(r["text"]) for r in lines])
    first = {}
    for r in sorted(lines, key=lambda r: r["doc_id"]):
        first.setdefault(fps[brute_fp(r["text"])], r["doc_id"])
    assert sorted(r["doc_id"] for r in near) == sorted(first.values())
    near = sorted(near, key=lambda r: r["doc_id"])
    want = {r["doc_id"]: w[3].decode(errors="replace") for r, w in zip(near, brute_cut([r["text"].encode() for r in near], p.REPEAT_BYTES)) if w[3]}
    assert {r["doc_id"]: r["text"] for r in cut} == want
    assert all(r["n_chars"] == len(r["text"]) for r in cut)
    check_packed(bins, packing.SIZES)
    assert sorted((r["doc_id"], r["n_places"]) for r in p.run(spark, d).collect()) == sorted((r["doc_id"], r["n_places"]) for r in bins)


def test_pipeline_cuts_passages_of_over_fifty_words_inside_one_line(spark):
    """Passages of 51 words that two documents share, each a part of one long
    line: no window of 51 words is left in both."""
    import corpus_pipeline as p
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))
    passages = [" ".join(word() for _ in range(51)) for _ in range(12)]
    texts = [" ".join([*(word() for _ in range(40)), passages[i % 12], *(word() for _ in range(40))]) for i in range(24)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r["text"] for r in p.substring_stage(spark, df, "").collect()}
    assert len(got) == 24 and all(min(map(len, passages)) > 0 and passages[i % 12][20:-20] not in got[i] for i in got)
    # what is a document's own stays
    assert all(texts[i][:150].split()[0] in got[i] and texts[i].split()[-1] in got[i] for i in got)


def test_pipeline_of_no_documents_and_clashing_columns(spark):
    import corpus_pipeline as p
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    none = base.limit(0)
    odd = base.withColumns({c: F.lit("x") for c in ("row", "k_id", "__lang", "__score", "fp", "core", "marks", "kept", "bin_id")})
    for _, stage in p.STAGES:
        none, odd = stage(spark, none, "").checkpoint(), stage(spark, odd, "").checkpoint()
    assert none.count() == 0 and odd.count() > 0


def test_pipeline_rows_with_odd_documents(spark):
    import corpus_pipeline as p
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = base.unionByName(odd)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, "").checkpoint()
    assert docs.filter("doc_id in (1, 2, 3)").count() > 0
