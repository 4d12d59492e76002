"""Near-duplicate operators (1, 2, 3, 10) against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import cases
from tillscope.llm import license_scan, line_dedup, minhash, spotsigs
from tillscope.llm.common import saved
from tillscope.llm.components import components
from tillscope.llm.line_dedup import dedup_lines
from tillscope.llm.minhash import near_duplicates
from tillscope.llm.queries import LINE_BOUND
from tillscope.llm.spotsigs import edited_fingerprints, near_pairs, with_signatures


def roots(ids, links):
    of = {i: i for i in ids}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def family(seed, n, edits):
    """Near copies of one text, each with some words replaced, so that not all of them link directly."""
    r = random.Random(seed)
    words = cases.prose(seed, 120).split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(r.randrange(edits)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check_near(spark, rows):
    got = {r.doc_id: r for r in near_duplicates(cases.table(spark, rows)).collect()}
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_near_duplicates_awkward(spark):
    check_near(spark, cases.distinct_ids())
    again = near_duplicates(cases.table(spark)).where("doc_id = 2 or doc_id is null").collect()
    assert {(r.doc_id, r.component_id) for r in again} == {(2, 1), (None, 1)}


def test_rows_that_repeat_an_id_with_other_text_keep_their_links(spark):
    a, b = cases.prose(31, 60), cases.prose(32, 60)
    rows = [(1, a), (1, b), (1, b), (5, a + " more"), (6, b + " more"), (7, cases.prose(33, 60)), (8, None)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(cases.table(spark, rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (1, 1, True), (5, 1, False), (6, 1, False), (7, 7, True), (8, 8, True)]
    first = sorted((r.row.doc_id, r.first) for r in minhash.near_rows(cases.table(spark, rows)).collect())
    assert first == [(1, True), (1, True), (1, True), (5, False), (6, False), (7, True), (8, True)]


def test_near_duplicates_families(spark):
    texts = family(11, 60, 9) + family(12, 40, 5) + [cases.prose(s, 100) for s in range(50, 80)]
    order = list(range(len(texts)))
    random.Random(0).shuffle(order)
    check_near(spark, [(i * 7 - 100, texts[k]) for i, k in enumerate(order)])


@pytest.mark.parametrize("setting", [{"BLOCK": 8, "TRY_HUBS": 0}, {"LOOKS_ALIKE": 1.01}])
def test_every_link_is_found_either_way(spark, monkeypatch, setting):
    """Links found in the blocks of a cluster alone, and by the join of buckets alone."""
    for name, value in setting.items():
        monkeypatch.setattr(minhash, name, value)
    texts = family(21, 50, 8) + [cases.prose(s, 60) for s in range(90, 100)]
    check_near(spark, list(enumerate(texts)))


def test_components_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def within_one(a, b):
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) < 8:
        return False
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
    return min(head + tail, min(len(a), len(b))) >= max(len(a), len(b)) - 1


def check_lines(spark, rows):
    got = {r.doc_id: r for r in dedup_lines(cases.table(spark, rows)).collect()}
    where, first = [], {}
    for i, t in sorted(rows):
        for k, x in enumerate((t or "").split("\n")):
            if n := x.strip(" ").lower():
                where.append((i, k, n))
                first.setdefault(n, (i, k))
    near = {b for a in first for b in first if first[a] < first[b] and within_one(a.split(" "), b.split(" "))}
    gone = defaultdict(set)
    for i, k, n in where:
        if n in near or first[n] != (i, k):
            gone[i].add(k)
    for i, t in rows:
        parts = (t or "").split("\n")
        assert got[i].text == "\n".join(x for k, x in enumerate(parts) if k not in gone[i]), i
        assert got[i].n_removed == len(gone[i]) and got[i].n_lines == (0 if t is None else len(parts))
        assert got[i].row.text == t and got[i].row.line == "l"


def test_line_dedup_awkward(spark):
    check_lines(spark, cases.distinct_ids())
    assert dedup_lines(cases.table(spark)).where("doc_id is null").first().n_removed == 0


def test_line_dedup_edits(spark):
    r, rows = random.Random(3), []
    for i in range(40):
        lines = []
        for _ in range(6):
            w = cases.prose(r.randrange(8), r.choice([7, 8, 9, 15])).split()
            edit, at = r.randrange(4), r.randrange(len(w))
            w = [w, w[:at] + w[at + 1:], w[:at] + ["new"] + w[at:], w[:at] + [f"y{r.randrange(3)}"] + w[at + 1:]][edit]
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    check_lines(spark, rows)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_line_dedup_bound_grows_with_length(spark):
    """Lines of 4 to 60 words, changed by up to five edits, against the distances of all pairs."""
    r, rows = random.Random(7), []
    for i in range(30):
        lines = []
        for _ in range(5):
            w = cases.prose(r.randrange(5), r.choice([4, 5, 9, 10, 19, 20, 60])).split()
            for _ in range(r.randrange(6)):
                at = r.randrange(len(w))
                w[at:at + 1] = r.choice([[], ["new", w[at]], [f"y{r.randrange(3)}"], [f"y{r.randrange(3)}"]]) if len(w) > 3 else [w[at]]
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    got = {x.doc_id: x.text for x in dedup_lines(cases.table(spark, rows), **LINE_BOUND).collect()}
    seen, far = [], 0
    for i, text in rows:
        stay = []
        for line in text.split("\n"):
            a = line.split(" ")
            bound = lambda b: min(4, max(1, min(len(a), len(b)) // 5)) if max(len(a), len(b)) >= 4 else 0
            d = [(edits(a, b), bound(b)) for b in seen if abs(len(a) - len(b)) <= 4]
            near = any(x <= most for x, most in d)
            far += near and min(x for x, _ in d) > 1
            stay += [] if near else [line]
            seen.append(a)
        assert got[i] == "\n".join(stay), i
    assert far > 10


def test_rows_that_repeat_an_id_with_other_text_keep_their_own_lines(spark):
    rows = [(1, "alpha line one"), (2, "alpha line one\nunique bee"), (2, "unique cat\nalpha line one"), (2, "unique cat\nalpha line one"), (3, "unique bee")]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(cases.table(spark, rows)).collect())
    assert got == [(1, "alpha line one", 0), (2, "unique bee", 1), (2, "unique cat", 1), (2, "unique cat", 1), (3, "", 1)]


def test_near_lines_make_no_pairs(spark, monkeypatch):
    """A family of near lines: the rows of every written step grow with the lines, not with their pairs."""
    base, rows = cases.prose(4, 20).split(), {}
    for n in (30, 120):
        lines = [" ".join(base[:k % 20] + [f"w{k}"] + base[k % 20 + 1:]) for k in range(n)]
        written = []

        def counted(df, name):
            out = saved(df, name)
            written.append(out.count())
            return out

        monkeypatch.setattr(line_dedup, "saved", counted)
        kept = dedup_lines(cases.table(spark, list(enumerate(lines))), **LINE_BOUND).where("text != ''").collect()
        assert [r.doc_id for r in kept] == [0]
        rows[n] = max(written)
    assert rows[120] <= 6 * rows[30]


def test_blocks_find_every_witness(spark, monkeypatch):
    """Lines that are near an earlier line of a key, but not the key's earliest one."""
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    base = cases.prose(8, 10).split()
    chain = [" ".join([f"x{j}" if j < k else w for j, w in enumerate(base)]) for k in range(8)]  # each differs from the one before by one word
    rows = [(i, t) for i, t in enumerate(chain)] + [(100 + i, t + " tail") for i, t in enumerate(chain)]
    check_lines(spark, rows)


def test_line_keys_are_not_written_and_are_moved_as_two_numbers(spark, monkeypatch):
    """A line of 40 words has some 20 keys: what is written of it holds none, and each is moved with one number."""
    steps, rows = {}, [(i, "\n".join(" ".join(f"w{i}x{j}x{k}" for k in range(40)) for j in range(20))) for i in range(100)]

    def sized(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        out = saved(df, name)
        steps[name] = (sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles()), plan)
        return out

    monkeypatch.setattr(line_dedup, "saved", sized)
    assert dedup_lines(cases.table(spark, rows), **LINE_BOUND).where("n_removed > 0").isEmpty()
    assert steps["lines"][0] < 60 * 2000
    keys = line_dedup.with_keys(spark.sql("select 1L h1, 'a b c d e' line"), spark.sql("select 5 n"), 4, 4, 5)
    assert keys.dtypes == [("key", "bigint"), ("name", "bigint")]
    assert steps["candidates"][1].count("Window") == 1 and "Join LeftSemi" not in steps["candidates"][1]


def test_copies_below_the_hot_ones_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1)
    base = cases.prose(5, 12)
    rows = [(i, base + "\n" + base.replace(" ", f" x{i % 3} ", 1)) for i in range(30)]
    check_lines(spark, rows)


def test_licenses_against_duckdb(spark, tmp_path):
    import duckdb
    rows = cases.awkward() + [(None, "All rights reserved."), (None, None)] + [(100 + k, cases.prose(k, 30) + "\n" + t.replace("free", "FREE!") + " " + cases.prose(k, 30))
                                   for k, t in enumerate(license_scan.LICENSES.values())]
    rows += [(300, " ".join(license_scan.LICENSES["mit"].split()[:50])), (301, " ".join(license_scan.LICENSES["mit"].split()[:75])),
             (302, " ".join(license_scan.LICENSES.values()))]
    got = license_scan.scan_licenses(cases.table(spark, rows)).toPandas()
    con = duckdb.connect()
    documents = cases.table(spark, rows).select("doc_id", "text").toPandas()  # noqa: F841 read by DuckDB
    want = con.execute(license_scan.oracle_sql()).df()
    key = ["doc_id", "license"]
    got, want = (x.fillna({"doc_id": -99}).sort_values(key)[list(got.columns)].values.tolist() for x in (got, want))
    assert got == want
    assert len(got) > 20 and any(r[0] == -99 for r in got)


def test_licenses_verify_retrieved_pairs_only(spark, monkeypatch):
    """Without bands nothing is retrieved, so nothing is verified; without templates nothing matches."""
    docs = cases.table(spark, [(1, license_scan.LICENSES["mit"]), (None, license_scan.LICENSES["mit"])])
    assert {(r.doc_id, r.license) for r in license_scan.scan_licenses(docs).collect()} >= {(1, "mit"), (None, "mit")}
    assert license_scan.scan_licenses(docs, {}).count() == 0
    assert license_scan.scan_licenses(docs, {"none": "", "marks": "!!!"}).count() == 0
    monkeypatch.setattr(license_scan, "_bands", lambda bands: F.explode(F.array(F.rand())).alias("band"))
    assert license_scan.scan_licenses(docs).count() == 0


def test_fingerprints(spark):
    rows = cases.awkward()
    got = edited_fingerprints(cases.table(spark)).collect()
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -10**18), r[1] or ""))
    want = defaultdict(list)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        want[i].append((len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.n_chars, r.edited_sha256))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    texts, prints = dict(rows), {r.doc_id: r.fingerprint for r in got}
    assert all((texts[a] or "") != (texts[b] or "") or prints[a] == prints[b] for a, b in combinations(prints, 2))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_fingerprints_of_texts_without_listed_anchors(spark):
    """Long texts that share their first words only differ; a copy with one changed word stays alike; short ones differ too."""
    r = random.Random(9)
    long = ["начало текста " + " ".join(f"слово{r.randrange(10**6)}" for _ in range(200)) for _ in range(2)]
    changed = long[0].split()
    changed[100] = "другое"
    texts = [*long, " ".join(changed), "header row x1 y2", "header row z3 q4"]
    got = [set(s.s) for s in with_signatures(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "t", "s").orderBy("i").collect()]
    assert min(len(s) for s in got[:3]) > 25
    assert len(got[0] & got[1]) <= 1 and len(got[0] & got[2]) >= 0.8 * len(got[0] | got[2])
    assert got[3] != got[4]


def plain_signatures(text):
    """The signatures as tuples of words, by plain Python over the words of a text."""
    if not text:
        return frozenset()
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [(k, w) for k, w in enumerate(words) if w not in spotsigs.COMMON]
    out, listed = set(), False
    for start in [-1, *(k for k, w in enumerate(words) if w in spotsigs.ANCHORS)]:
        after = [w for k, w in content if k > start][:spotsigs.CHAIN]
        if len(after) == spotsigs.CHAIN:
            out.add(("start" if start < 0 else words[start], *after))
            listed |= start >= 0
    bounds = [-1, *(k for k, w in enumerate(words) if w in spotsigs.ANCHORS), len(words)]
    own = set()
    for lo, hi in zip(bounds, bounds[1:]):
        stretch = [w for k, w in content if lo < k < hi]
        own |= {("own", *stretch[i:i + spotsigs.CHAIN + 1]) for i in range(spotsigs.LONELY, len(stretch) - spotsigs.CHAIN)
                if xxhash.xxh64_intdigest(stretch[i].encode(), 42) % spotsigs.EVERY == 0}
    return frozenset(out | own | (set() if listed or own else {("whole", text)}))


def plain_likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_likeness_against_plain_python(spark):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)] + ["the", "a", "und", "with", "in", "it"] * 2
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 5, 12, 13, 14, 40, 200, 800] * 3)]
    rows += [(100, " ".join(f"x{k}" for k in range(90))), (101, "the " + " ".join(f"x{k}" for k in range(90))), (102, "The, quick-brown; FOX " * 9)]
    got = {s.doc_id: s for s in edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 3] + after[:len(t) // 3]
        mine = plain_signatures(t)
        assert (got[i].n_signatures, got[i].near_edited, got[i].near_next) == (
            len(mine), plain_likeness(mine, plain_signatures(edited)), plain_likeness(mine, plain_signatures(after))), (i, t)


def test_one_more_character_keeps_the_fingerprint(spark):
    """Texts with few anchors, at any length: one character more leaves a likeness of 0.9 at least."""
    r = random.Random(11)
    words = [("the " if k % 25 == 10 else "") + f"wort{r.randrange(10**5)}" for k in range(200)]
    texts = [" ".join(words)[:n] for n in range(1190, 1212)]
    got = [set(s.s) for s in with_signatures(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "t", "s").orderBy("i").collect()]
    assert min(map(len, got)) > 15
    assert all(len(a & b) >= 0.9 * len(a | b) for a, b in zip(got, got[1:]))


def test_near_pairs_by_length(spark):
    r = random.Random(5)
    base = [sorted(r.sample(range(1000), n)) for n in (3, 20, 21, 40) for _ in range(4)]
    sets = base + [sorted(set(s[:-1] + [2000 + k])) for k, s in enumerate(base)] + base[:3] + [[]]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "doc_id long, signatures array<int>")
    members, pairs = near_pairs(frame, 0.75)
    classes = {tuple(s): min(i for i, t in enumerate(sets) if t == s) for s in sets if s}
    assert {(r.id, r["class"]) for r in members.collect()} == {(i, classes[tuple(s)]) for i, s in enumerate(sets) if s}
    want = {(min(a, b), max(a, b)) for (s, a), (t, b) in combinations(classes.items(), 2)
            if len(set(s) & set(t)) >= 0.75 * len(set(s) | set(t))}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


@pytest.mark.parametrize("operator", [near_duplicates, dedup_lines, edited_fingerprints, license_scan.scan_licenses])
def test_empty_tables(spark, operator):
    assert operator(cases.empty(spark)).count() == 0


def test_single_document_follows_itself(spark):
    r = edited_fingerprints(cases.table(spark, [(3, "abcdef")])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1


def test_native_plans_run_no_python(spark):
    for frame in (edited_fingerprints(cases.table(spark)), license_scan.scan_licenses(cases.table(spark)), dedup_lines(cases.table(spark))):
        assert "Python" not in (plan := frame._jdf.queryExecution().executedPlan().toString()) and "Arrow" not in plan
