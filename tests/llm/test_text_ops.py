"""Line chunks, URL filter, licences, language, BPE and quality rules against
brute force, and the defined results of odd inputs."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.llm import bpe, langid, license_scan, line_chunks, quality_rules
from tierline.llm.line_chunks import dedup_lines, dedup_passages, with_chunks
from tierline.llm.url_filter import judge_urls

MID = "/root/testdata/sf0.01"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)
    if extra:          # names the operators use themselves
        df = df.withColumns({c: F.lit("x") for c in ("key", "row", "hash", "k_id", "marks", "pack", "words", "__key", "fp", "c", "i")})
    return df


ODD = [(1, None), (2, ""), (3, " \t\n\n "), (None, "a b c\nd e f\ng"), (4, "a b c\nd e f\ng"), (4, "a b c\nd e f\ng"),
       (5, "long " * 30000), (6, "x"), (7, "é ñ ü\nß")]


# -- line chunks --------------------------------------------------------------

def chunks_of(text, divisor):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    n, p = len(lines), line_chunks.PRIME
    raw = [i > 0 and (h[i - 1] % p * line_chunks.BASE + h[i]) % p < p // divisor for i in range(n)]
    again = [i > 1 and h[i] == h[i - 2] for i in range(n)]
    cuts, i = {n - 1}, 0
    while i < n:
        if again[i]:
            cuts.update(k for k in range(i - 1, n) if (k - i) % 2 == 1 and all(again[i:k + 1]))
            while i < n and again[i]:
                i += 1
        else:
            if raw[i] and not raw[i - 1]:
                cuts.add(i)
            i += 1
    ends = sorted(cuts)
    return [lines[a + 1:b + 1] for a, b in zip([-1, *ends], ends)]


def brute_lines(rows, divisor=3):
    seen, kept = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        left = []
        for c in chunks_of(t, divisor):
            body = "\n".join(c)
            if sum(bool(x.strip()) for x in c) >= 2 and body in seen:
                continue
            if sum(bool(x.strip()) for x in c) >= 2:
                seen.add(body)
            left.append(body)
        kept[i] = "\n".join(left)
    return kept


def test_line_chunks_match_brute_force(spark):
    rng = random.Random(3)
    passage = [f"shared line {i} words" for i in range(40)]
    rows = []
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randint(1, 12))]
        a = rng.randint(0, 30)
        rows.append((i, "\n".join(own + passage[a:a + rng.randint(0, 12)] + own[:2] + [""] * rng.randint(0, 2))))
    got = {r["doc_id"]: r["text"] for r in dedup_lines(docs(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert any(got[i] != t for i, t in rows)


def test_line_chunks_are_shift_resistant(spark):
    body = [f"line number {i} of a passage" for i in range(60)]
    rows = [(1, "\n".join(body)), (2, "\n".join(["one", "two", "three"] + body))]
    got = {r["doc_id"]: r for r in dedup_lines(docs(spark, rows)).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["removed_lines"] > 40


def test_runs_alternating_lines_and_short_passages(spark):
    """Runs and alternating lines leave one pair (and what is odd at an end); of
    passages between different lines, longer ones go more often."""
    rows = [(1, "\n".join(["same"] * 60)), (2, "\n".join(["a", "b"] * 40)), (3, "x\n" + "\n".join(["same"] * 9)), (4, "one\ntwo\none\ntwo\nend")]
    got = {r["doc_id"]: r["text"].split("\n") for r in dedup_lines(docs(spark, rows)).collect()}
    assert got == {i: t.split("\n") for i, t in brute_lines(rows).items()}
    assert got[1].count("same") <= 4 and len(got[2]) <= 4 and got[3].count("same") <= 3
    rng, left = random.Random(1), {}
    for n in (2, 4, 8, 16):
        rows = []
        for i in range(120):
            a = [f"top {n} {i} {rng.random()}", *(f"{n} passage {i % 40} {k}" for k in range(n)), f"foot {n} {i} {rng.random()}"]
            rows.append((i, "\n".join(a)))
        out = {r["doc_id"]: r for r in dedup_lines(docs(spark, rows)).collect()}
        left[n] = 1 - sum(out[i]["removed_lines"] for i in range(40, 120)) / (80 * n)
    assert left[2] > left[4] > left[8] > left[16] and left[16] < 0.4, left


def test_line_chunks_odd_inputs(spark):
    out = dedup_lines(docs(spark, ODD, extra=True))
    rows = out.collect()
    assert len(rows) == len(ODD) and {"key", "__key", "i"} <= set(out.columns)
    by = {(r["doc_id"], r["key"]): r["text"] for r in rows}
    assert by[(1, "x")] is None and by[(2, "x")] == "" and by[(6, "x")] == "x"
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["a b c\nd e f\ng"] * 2      # equal rows: alike
    assert dedup_lines(docs(spark, [])).count() == 0
    assert with_chunks(docs(spark, [(1, "a\nb")]), "text", 3, "chunks").first()["chunks"][0]["lines"] >= 1


def brute_passages(rows):
    seen, kept = {}, {}
    for i, t in sorted(rows):
        ls = t.split("\n")
        at = [j for j, x in enumerate(ls) if x.strip()]
        gone = set()
        for k, (a, b) in enumerate(zip(at, at[1:])):
            first = seen.setdefault("\n".join(ls[a:b + 1]), (i, k))
            if first != (i, k):
                gone |= set(range(a + (first == (i, k - 1)), b + 1))
        kept[i] = "\n".join(x for j, x in enumerate(ls) if j not in gone)
    return kept


def test_passages_go_whole_wherever_they_stand(spark):
    """Also runs of one line, alternating lines and passages of two lines."""
    rng = random.Random(5)
    passage = [f"shared {i}" if i % 7 else "" for i in range(40)]
    rows = [(0, "\n".join(["same"] * 90 + ["a", "b"] * 30)), (1, "x\nsame\nsame\ny\na\nb\nz")]
    for i in range(2, 80):
        a, own = rng.randint(0, 37), [f"own {i} {j}" for j in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(own + passage[a:a + rng.randint(2, 5)] + [f"end {i}"] + [rng.choice("pq")] * rng.randint(0, 4))))
    out = dedup_passages(docs(spark, rows, extra=True).repartition(5)).collect()
    got, want = {r["doc_id"]: r["text"] for r in out}, brute_passages(rows)
    assert got == want and got[0] == "same\nsame\na\nb" and got[1] == "x\ny\nz"
    assert all(r["removed_lines"] == dict(rows)[r["doc_id"]].count("\n") - r["text"].count("\n") for r in out if r["text"])


def test_pipeline_stage_cuts_short_and_periodic_passages(spark):
    from corpus_pipeline import line_stage
    rows = [(i, f"start {i}\nshared one\nshared two\nend {i}") for i in range(20)] + [(20, "\n".join(["run"] * 50))]
    got = {r["doc_id"]: r["text"] for r in line_stage(spark, docs(spark, rows), "").collect()}
    assert got == {0: rows[0][1], 20: "run\nrun"} | {i: f"start {i}\nend {i}" for i in range(1, 20)}


def brute_stage(rows, divisor=3):
    """The lines that neither a later chunk nor a later window takes."""
    lines, seen, kept = {i: t.split("\n") for i, t in rows}, set(), {}
    for i, t in sorted(rows):
        gone, n = set(), 0
        for c in chunks_of(t, divisor):
            if sum(bool(x.strip()) for x in c) >= 2:
                gone |= set(range(n, n + len(c))) if tuple(c) in seen else set()
                seen.add(tuple(c))
            n += len(c)
        kept[i] = gone
    first = {}
    for i, t in sorted(rows):
        at = [j for j, x in enumerate(lines[i]) if x.strip()]
        for k, (a, b) in enumerate(zip(at, at[1:])):
            f = first.setdefault("\n".join(lines[i][a:b + 1]), (i, k))
            if f != (i, k):
                kept[i] |= set(range(a + (f == (i, k - 1)), b + 1))
        kept[i] = "\n".join(x for j, x in enumerate(lines[i]) if j not in kept[i])
    return kept


def test_pipeline_stage_cuts_chunks_of_the_rolling_hash(spark):
    """Chunks go with the blank lines at their edges, which no window holds;
    windows take what the cuts miss, and of every line a place stays."""
    from corpus_pipeline import line_stage
    rng = random.Random(8)
    passage = ["" if rng.random() < 0.3 else f"shared {k}" for k in range(60)]
    rows = []
    for i in range(60):
        a, own = rng.randint(0, 50), [f"own {i} {k}" for k in range(rng.randint(1, 4))]
        rows.append((i, "\n".join(own + passage[a:a + rng.randint(2, 30)] + [""] * rng.randint(0, 2) + [f"end {i}"] + ["run"] * rng.randint(0, 5))))
    want = brute_stage(rows)
    assert want != brute_passages(rows)
    got = {r["doc_id"]: r["text"] for r in line_stage(spark, docs(spark, rows).repartition(5), "").collect()}
    assert got == {i: t for i, t in want.items() if t}
    assert {x for t in got.values() for x in t.split("\n") if x} == {x for _, t in rows for x in t.split("\n") if x}


def test_pipeline_stage_of_equal_ids_keeps_a_place_of_every_line(spark):
    from corpus_pipeline import line_stage
    rng = random.Random(2)
    for ids in ((1, 1, 1), (None, None, 2)):
        body = [f"line {k} {rng.random()}" for k in range(40)]
        rows = [(ids[0], "\n".join(body)), (ids[1], "\n".join(["one", "two", "three"] + body)), (ids[2], "\n".join(body[5:] + ["tail", "end"]))]
        out = [r["text"] for r in line_stage(spark, docs(spark, rows), "").collect()]
        left = [x for t in out for x in t.split("\n")]
        assert set(left) == {x for _, t in rows for x in t.split("\n")} and len(left) < 60


def test_no_repeat_of_two_lines_stays(spark):
    rows = [(i, "\n".join([f"top {i}", *(f"{i // 10} line {k}" for k in range(2 + i // 10)), f"foot {i}"])) for i in range(40)]
    got = {r["doc_id"]: r["text"] for r in dedup_passages(docs(spark, rows)).collect()}
    assert got == {i: t if i % 10 == 0 else f"top {i}\nfoot {i}" for i, t in rows}


def test_passages_odd_inputs(spark):
    rows = dedup_passages(docs(spark, ODD, extra=True)).collect()
    by = {r["doc_id"]: r["text"] for r in rows}
    assert len(rows) == len(ODD) and by[1] is None and by[2] == "" and by[3] == " \t\n\n " and by[6] == "x"
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["a b c\nd e f\ng"] * 2 and by[None] == ""
    assert dedup_passages(docs(spark, [])).count() == 0


# -- URL filter ---------------------------------------------------------------

RULES = [("com", "/", "allow"), ("bad.com", "/x/", "block"), ("net", "/es/", "block")]


def test_url_filter_rules_and_odd_urls(spark):
    rows = [(1, None), (2, "no scheme/path"), (3, "http://A.Bad.COM/x/1?q#f"), (4, "http://bad.com/y"), (5, "ftp://u@Host:1#z"),
            (6, "://"), (7, "http://h.net/es/1"), (7, "http://h.net/es/1"), (8, "http://bad.company/x/"), (9, "http://a//b/" + "c/" * 3000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash")).withColumn("tpl", F.lit(1))
    got = {r["page_id"]: r for r in judge_urls(df, RULES).collect()}
    assert judge_urls(df, RULES).count() == len(rows)
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("", "", None, "allow")
    assert got[2]["host"] == "" and got[6]["host"] == ""
    assert (got[3]["host"], got[3]["path"], got[3]["rule"], got[3]["verdict"]) == ("a.bad.com", "/x/1", "bad.com/x/", "block")
    assert (got[4]["rule"], got[4]["verdict"]) == ("com/", "allow")
    assert (got[5]["host"], got[5]["path"]) == ("u@host:1", "")
    assert got[7]["verdict"] == "block" and got[8]["rule"] is None
    assert got[9]["template"] == "**"               # nothing is told by one page
    assert judge_urls(df.limit(0), RULES).count() == 0


def test_url_templates_are_rejected_by_labelled_purity(spark):
    """A sub-tree whose labelled pages are all blocked rejects its unlabelled
    ones; a mostly allowed one does not."""
    rules = [("h.net", f"/spam/{i}/", "block") for i in range(10, 40)] + [("h.net", f"/good/{i}/", "allow") for i in range(10, 40)]
    rows = [(i, f"http://h.net/spam/{i}/") for i in range(10, 60)] + [(i + 100, f"http://h.net/good/{i}/") for i in range(10, 60)]
    got = {r["page_id"]: r["verdict"] for r in judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert {got[i] for i in range(10, 60)} == {"block"} and {got[i + 100] for i in range(10, 60)} == {"allow"}


def brute_urls(pages, support=5, z=1.96, min_labels=5, k=5, cutoff=0.6):
    """(host, path, label) rows -> (template, verdict) of each."""
    segs = [re.sub("[0-9]+", "#", re.sub("^/", "", p)).split("/") for _, p, _ in pages]
    tpl, open_rows, d = [[] for _ in pages], set(range(len(pages))), 0
    while True:
        open_rows = {i for i in open_rows if len(segs[i]) > d}
        if not open_rows:
            break
        nodes = {}
        for i in open_rows:
            nodes.setdefault((pages[i][0], tuple(tpl[i])), {}).setdefault(segs[i][d], []).append(i)
        for children in nodes.values():
            small = [len(m) for m in children.values() if len(m) < support]
            varies = len(small) >= support and 2 * len(small) >= sum(small)
            thin = sum(map(len, children.values())) < support
            for seg, members in children.items():
                for i in members:
                    tpl[i] = [*tpl[i], "**" if thin else "*" if varies and len(members) < support else seg]
                    if thin:
                        open_rows.discard(i)
        d += 1
    labels = [x for _, _, x in pages if x]
    p = labels.count("block") / len(labels) if labels else 0.0
    count = {}
    for (h, _, x), t in zip(pages, tpl):
        c = count.setdefault((h, tuple(t)), [0, 0])
        c[0] += x is not None
        c[1] += x == "block"
    groups = {}
    for (h, t), (n, b) in count.items():
        at = next((j for j, x in enumerate(t) if x not in ("*", "**") and "#" not in x), None)
        off = b - n * p
        kind = None if n == 0 else 0 if off * off < z * z * p * (1 - p) * n or off == 0 else off > 0
        groups.setdefault((h, tuple("|" if j == at else x for j, x in enumerate(t)), str(kind)), []).append((h, t))
    verdict = {}
    for members in groups.values():
        n, b = (sum(count[m][j] for m in members) for j in (0, 1))
        name = min("/".join(t) for _, t in members)
        for m in members:
            verdict[m] = name, n >= min_labels and (b + k * p) / (n + k) > cutoff
    return [(verdict[h, tuple(t)][0], x or ("block" if verdict[h, tuple(t)][1] else "allow")) for (h, _, x), t in zip(pages, tpl)]


def test_url_templates_match_brute_force(spark):
    rng = random.Random(6)
    pages = []
    for i in range(900):
        host = "hot.net" if rng.random() < 0.4 else rng.choice(["a.com", "b.com", "c.org"])
        first = rng.choice(["blog", "news", "shop", "x%d" % rng.randint(0, 300), "img", ""])
        deep = [rng.choice(["tag", "p%d" % rng.randint(0, 9), f"{rng.choice('abc')}{rng.choice('xyz')}", "u" + str(rng.random())[2:9].translate(str.maketrans("0123456789", "abcdefghij"))])
                for _ in range(rng.choice([0, 1, 1, 2, 7]))]
        bad = first in ("shop", "img")
        label = None if rng.random() < 0.5 else ("block" if rng.random() < (0.9 if bad else 0.1) else "allow")
        pages.append((host, "/" + "/".join([first, *deep]), label))
    df = spark.createDataFrame([(i, f"http://{h}{p}", x) for i, (h, p, x) in enumerate(pages)], "page_id bigint, url string, known string")
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in judge_urls(df, [], label_col="known").collect()}
    want = brute_urls(pages)
    assert got == dict(enumerate(want))
    assert {w[1] for w, p in zip(want, pages) if p[2] is None} == {"block", "allow"} and any("*" in w[0] for w in want)


def test_no_plan_of_the_url_tree_holds_more_than_one_level(spark, monkeypatch):
    """However deep the paths: a plan of all levels, with the joins of each, takes
    the driver's memory."""
    from tierline.llm import url_filter
    joins, whole = [], url_filter.stable
    monkeypatch.setattr(url_filter, "stable", lambda df: joins.append(str(df._jdf.queryExecution().optimizedPlan()).count("Join ")) or whole(df))
    rows = [("h.net", [f"s{j}" for j in range(n)] + [f"p{i}"], 5, 2, 1) for n in (2, 6, 12) for i in range(6)]
    shapes = spark.createDataFrame(rows, "host string, segs array<string>, n bigint, n_lab bigint, n_block bigint")
    out = url_filter.template_tree(shapes, 5).collect()
    assert sorted(len(r["segs"]) for r in out) == [3] * 6 + [7] * 6 + [13] * 6 and len(joins) > 13
    assert max(joins) <= 2 and joins[-1] == 0


def test_a_section_of_a_hot_host_blocks_no_stranger(spark):
    """150 sections of 20 pages, one labelled section, and a few small ones."""
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i:03d}")
    rows = [f"http://hot.net/{name(i)}/{j}.html" for i in range(150) for j in range(20)] + [f"http://hot.net/es/{j}.html" for j in range(20)]
    rows += [f"http://s.net/{x}/{j}.html" for x, n in (("es", 4), ("fr", 4), ("de", 3)) for j in range(n)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    got = judge_urls(df, [("net", "/es/", "block"), ("net", "/fr/", "block")]).collect()
    assert all((r["verdict"] == "block") == (r["path"][:4] in ("/es/", "/fr/")) for r in got) and len(got) == len(rows)


# -- licences -----------------------------------------------------------------

@pytest.fixture(scope="module")
def license_model(spark):
    return license_scan.train(spark.read.parquet(f"{MID}/documents.parquet"))


def test_licences_found_and_confirmed(spark, license_model):
    rows = [(1, "Some text.\nReleased under the MIT License.\nMore text."), (2, "The driver showed his license."),
            (3, "intro words here Licensed under the Apache License, Version 2.0. and then more words"),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "Licensed under CC BY-NC 4.0."),
            (6, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:")]
    got = {r["doc_id"]: [(x["paragraph"], x["family"]) for x in r["licences"]] for r in license_scan.scan(docs(spark, rows), license_model).collect()}
    assert got[1] == [(1, "MIT")] and got[2] == [] and got[3] == [(0, "Apache-2.0")]
    assert got[4] == [(0, "GPL-3.0")] and got[5] == [(0, "CC-BY-NC")] and got[6] == [(0, "BSD")]


def test_real_notices_are_found(spark, license_model):
    """Two notices in a line, wrapped notices, notices in long lines, short
    lines, and words in between."""
    from tierline.llm.license_templates import TEMPLATES
    mit, apache = TEMPLATES["MIT"][3], TEMPLATES["Apache-2.0"][2]
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i:i + n]) for i in range(0, len(t.split()), n))
    filler = " ".join(f"word{i} of some long story" for i in range(300))
    rows = [(1, f"{mit} {apache}"), (2, wrap(mit, 12)), (3, "MIT License"), (4, f"{filler} {apache} {filler}"),
            (5, "Copyright 2024 someone\n\n" + wrap(mit, 10) + "\n\n" + wrap(apache, 9) + "\nend of it"),
            (6, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
            (7, f"{filler}\n{filler}"), (8, wrap(filler, 11)), (9, "the license\nof the software\nsubject to the following"),
            (10, "# " + wrap(mit, 8).replace("\n", "\n# "))]
    got = {r["doc_id"]: sorted({x["family"] for x in r["licences"]}) for r in license_scan.scan(docs(spark, rows), license_model).collect()}
    assert got[1] == got[5] == got[6] == ["Apache-2.0", "MIT"], got
    assert got[2] == got[3] == got[10] == ["MIT"] and got[4] == ["Apache-2.0"], got
    assert got[7] == got[8] == [] and set(got[9]) <= {"unknown"}, got
    for f, texts in TEMPLATES.items():             # every template, alone and wrapped
        rows = [(i, t) for i, t in enumerate([*texts, *(wrap(t, 7) for t in texts)])]
        for r in license_scan.scan(docs(spark, rows), license_model).collect():
            assert f in {x["family"] for x in r["licences"]}, (f, rows[r["doc_id"]], r["licences"])


def test_licences_of_the_corpus_match_a_plain_search(spark, license_model):
    df = spark.read.parquet(f"{MID}/documents.parquet")
    notices = {"GPL-3.0": "GNU General Public License, version 3.", "MIT": "Released under the MIT License.",
               "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    want = {r["doc_id"]: sorted(f for f, s in notices.items() if s in r["text"]) for r in df.collect()}
    got = {r["doc_id"]: sorted({x["family"] for x in r["licences"]}) for r in license_scan.scan(df, license_model).collect()}
    assert got == want and any(want.values())


def test_licence_scan_odd_inputs(spark, license_model):
    out = license_scan.scan(docs(spark, ODD, extra=True).withColumn("licences", F.lit(1)), license_model)
    assert out.count() == len(ODD) and [r["n_paragraphs"] for r in out.filter("doc_id < 4").orderBy("doc_id").collect()] == [0, 0, 0]
    assert license_scan.scan(docs(spark, []), license_scan.train(docs(spark, []))).count() == 0


# -- language -----------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    df = spark.read.parquet(f"{MID}/documents.parquet")
    model = langid.train(df.filter(~langid.held_out()))
    rows = langid.predict(df, model).filter(langid.held_out()).collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in langid.predict(docs(spark, ODD + [(8, "12 34 ?!")], extra=True), model).collect()}
    for i in (1, 2, 3, 8):
        assert (odd[i]["lang_pred"], odd[i]["score"]) == ("und", 0.0)
    assert odd[5]["lang_pred"] in model.langs


def test_text_of_other_languages_is_not_typical(spark):
    """One sentence each of languages that nobody has taught; documents of the
    corpus that have a letter are typical, but for a rare mixture of languages."""
    df = spark.read.parquet(f"{MID}/documents.parquet")
    model = langid.train(df.filter(~langid.held_out()))
    strangers = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan ja heille on annettu järki ja omatunto.",
                 "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar, akıl ve vicdana sahiptirler.",
                 "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem.",
                 "Все люди рождаются свободными и равными в своем достоинстве и правах.", "zxqj vvkk qqzx jjwv xkcd wqwq zzzz kkqx vxvx"]
    got = {r["doc_id"]: r for r in langid.predict(docs(spark, list(enumerate(strangers))), model).collect()}
    assert all(got[i]["typical"] < -1 for i in range(len(strangers))), [(r["lang_pred"], r["score"], r["typical"]) for r in got.values()]
    rows = langid.predict(df, model).filter("lang_pred <> 'und'").collect()
    assert np.mean([r["typical"] < -1 for r in rows]) < 0.003


def test_language_without_labels(spark):
    model = langid.train(docs(spark, ODD).withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.predict(docs(spark, ODD), model).collect()} == {"und"}
    assert langid.predict(docs(spark, []), langid.train(docs(spark, []))).count() == 0


def test_held_out_is_the_checksum_rule(spark):
    import zlib
    rows = spark.range(50).select(F.col("id").alias("doc_id"), langid.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


# -- BPE ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return bpe.read_ranks(path), public_tokenizers.PATTERN, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=150))
def test_word_encoding_matches_the_library(tokenizer, word):
    ranks, _, lib = tokenizer
    assert bpe.encode_word(word, ranks) == lib._encode_single_piece(word)


def test_long_words_match_the_library(tokenizer):
    ranks, _, lib = tokenizer
    rng = random.Random(1)
    for n in (41, 300, 5000):
        word = bytes(rng.choice(b"abethinos ") for _ in range(n))
        assert bpe.encode_word(word, ranks) == lib._encode_single_piece(word)


def test_bpe_matches_the_library_and_round_trips(spark, tokenizer):
    ranks, pattern, lib = tokenizer
    rows = ODD + [(8, "don't  stop \n\n 12345 ǅ 𝒳 日本語    x \x1c"), (9, "<|endoftext|>"), (10, "aaaa" * 500)]
    out = bpe.decode(bpe.encode(docs(spark, rows, extra=True), ranks, pattern, pack_chars=200), ranks).collect()
    assert len(out) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for r in out:
        assert list(r["ids"]) == lib.encode_ordinary(texts[r["doc_id"]]) and bytes(r["decoded"]) == texts[r["doc_id"]].encode()
        assert r["key"] == "x"
    assert bpe.decode(bpe.encode(docs(spark, []), ranks, pattern), ranks, digest=True).count() == 0


# -- quality rules ------------------------------------------------------------

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    cover = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(cover))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c#", "\n", "é", "a\n"]), max_size=60))
def test_counts_match_brute_force(parts):
    text = " ".join(parts)
    assert quality_rules._count(text) == brute_counts(text)


def test_quality_odd_inputs_and_base_rule(spark):
    got = quality_rules.judge_quality(docs(spark, ODD, extra=True)).collect()
    assert len(got) == len(ODD)
    for r in got:
        text = next(t for i, t in ODD if i == r["doc_id"])
        if r["doc_id"] != 5:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(text)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge_quality(docs(spark, [])).count() == 0


def test_mcd_finds_the_subset_of_least_determinant(spark):
    """Against all subsets of 14 of 18 rows; outliers lie together, off the
    direction in which the statistics vary."""
    import itertools
    floor = np.square(list(quality_rules.FLOOR.values()))
    rows, want = [], {}
    for g in range(6):
        rng = np.random.default_rng(g)
        x = rng.normal(size=(18, 1)) * np.array([[2.0, 0.5, 1.0, 1.5, 0.4]]) + rng.normal(size=(18, 5)) * 0.15
        x[14:] += np.array([[-3.0, 2.0, 4.0, 3.0, 1.0]]) * (1 + g / 4)
        best = min(itertools.combinations(range(18), 14),
                   key=lambda c: np.linalg.slogdet(np.cov(x[list(c)].T, bias=True) + np.diag(floor))[1])
        want[g] = x[list(best)].mean(axis=0)
        rows += [(g, *map(float, r)) for r in x]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{v} double" for v in quality_rules.VECTOR)).repartition(5)
    got = {r["g"]: r for r in quality_rules.fit_mcd(df, ["g"], 0.75, 4).collect()}
    same = [np.allclose(got[g]["mean"], want[g], rtol=1e-9) for g in want]
    assert set(got) == set(want) and sum(same) >= 5, same
    # each row against its own model: the outliers lie far off, the others do not
    for g, x in itertools.groupby(rows, key=lambda r: r[0]):
        x = np.array([r[1:] for r in x])
        prec = np.array(got[g]["prec"]).reshape(5, 5)
        d = np.einsum("ni,ij,nj->n", x - got[g]["mean"], prec, x - got[g]["mean"])
        assert d[14:].min() > np.quantile(d[:14], 0.9)


def test_quality_matches_labels(spark):
    df = spark.read.parquet(f"{MID}/documents.parquet")
    rows = quality_rules.judge_quality(df).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1
