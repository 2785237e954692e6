"""Near-duplicates, repeated passages and benchmark leaks."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash

from galecast.llm import decontam, simhash, substrings
from galecast.llm.oracle import OP3
from galecast.llm.text import WORD
from oracle_check import compare

WORDS = [f"w{i}" for i in range(400)]


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    parts = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    ones = np.zeros(64, int)
    for part in parts:
        h = xxhash.xxh64_intdigest(part.encode(), 42)
        ones += [h >> k & 1 for k in range(64)]
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(parts))


def plain_components(rows):
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(rows))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted((str(i), f"{int(f):016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, label)), label


def test_near_duplicates_equal_brute_force(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 2000").select("doc_id", "text")
    docs = docs.selectExpr("doc_id + 1000 as doc_id", "text").unionByName(odd.where("doc_id is null or doc_id <> 105").select("doc_id", "text"))
    want, _ = plain_components([tuple(r) for r in docs.collect()])
    assert sorted((str(r[0]), r[1], r[2]) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_class_stays(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    _, label = plain_components(rows)
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    classes = collections.defaultdict(list)
    for (i, t), c in zip(rows, label):
        classes[c].append((i is None, i or 0, t))
    want = sorted((i if not none else None) or -1 for none, i, _ in (min(x, key=lambda r: r[:2]) for x in classes.values()))
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == want
    assert simhash.one_of_each(empty).count() == 0


def test_segments_leave_one_differing_bit():
    for distance in range(8):
        cuts = simhash.segments(distance)
        assert sum(n for _, n in cuts) == 64 and distance // len(cuts) <= 1


@pytest.mark.parametrize("crowd", [0, 300])
def test_links_connect_what_all_pairs_connect(spark, crowd):
    random = np.random.default_rng(3)
    fps = random.integers(0, 1 << 63, 200, dtype=np.uint64)
    flips = [fps[i % 200] ^ np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, 1 + i % 6, dtype=np.uint64)) for i in range(300)]
    flips += [fps[0] ^ (np.uint64(1) << np.uint64(i % 64)) ^ (np.uint64(1) << np.uint64(i * 7 % 64)) for i in range(crowd)]
    fps = np.unique(np.concatenate([fps, np.array(flips, np.uint64)]))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["fp"]: r["class"] for r in simhash.classes(table).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fps))])
        if (new == label).all():
            break
        label = new
    groups = lambda keys: sorted(sorted(v) for v in keys.values())
    mine, want = collections.defaultdict(list), collections.defaultdict(list)
    for x, c in zip(fps.view(np.int64).tolist(), label):
        mine[got[x]].append(x)
        want[c].append(x)
    assert groups(mine) == groups(want)
    assert simhash.links(table).count() <= len(fps) * simhash.BITS


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


def plain_removal(rows, k):
    least = {}
    words = [(i, re.findall(WORD, t or "")) for i, t in rows]
    for i, w in words:
        if i is not None:
            for j in range(len(w) - k + 1):
                g = tuple(w[j : j + k])
                least[g] = min(least.get(g, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if i is not None and least[tuple(w[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def passages(count):
    """Documents that share passages of many lengths at many places, with repeats inside one document and contained ones."""
    random = np.random.default_rng(count)
    shared = [[WORDS[x] for x in random.integers(0, 400, n)] for n in (49, 50, 51, 60, 99, 150, 26, 25)]
    out = []
    for i in range(count):
        words = [WORDS[x] for x in random.integers(0, 400, random.integers(0, 120))]
        for _ in range(random.integers(0, 4)):
            part = shared[random.integers(0, len(shared))]
            cut = random.integers(0, 10)
            at = random.integers(0, len(words) + 1)
            words[at:at] = part[cut:] if cut < 4 else part
        out.append((int(random.integers(0, 1000)), " ".join(words)))
    return out


def test_removed_passages_equal_brute_force(spark, odd, empty):
    rows = passages(150) + [(r["doc_id"], r["text"]) for r in odd.where("doc_id <> 105 or doc_id is null").collect()] + [(5000, "a " * 300), (5001, "a " * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((str(r[0]), *r[1:]) for r in substrings.repeated_documents(docs).collect())
    assert got == plain_removal(rows, 50)
    assert substrings.repeated_documents(empty).count() == 0


@pytest.mark.parametrize("window", [3, 8, 51])
def test_other_windows(spark, window):
    rows = passages(60)
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got) == plain_removal(rows, window)
    assert all(sum(s["words"] for s in r["spans"]) == r["n_removed"] for r in got)


ITEM = "A train leaves Berlin at 30 km per hour. After 5 hours it meets Anna, who left Berlin 2 hours later with 45 km per hour behind her."
OTHER = ITEM.replace("Berlin", "Madrid").replace("30", "70").replace("Anna", "Peter").replace("45", "99")
MIXED = ITEM.replace("leaves Berlin", "leaves Madrid")


def held(spark, texts, items):
    """The verdicts by document, after they were compared with those of the SQL."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.checked_documents(docs, bench).cache()
    tables = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", list(enumerate(texts))), ("benchmark", "item_id", items)):
        tables.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        tables.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert compare(got, tables, OP3) == ""
    return {r["doc_id"]: r for r in got.collect()}


def test_changed_slots_are_caught_and_clean_texts_are_not(spark):
    around = "and so it was said by many that the thing went on and on without any end in sight "
    texts = [around + ITEM + " " + around, around + OTHER, ITEM.lower(), "A train leaves Berlin at 30 km per hour. " + around, around, None, "", "30"]
    got = held(spark, texts, [(1, ITEM), (2, None), (3, ""), (4, "Yes."), (4, "Yes.")])
    assert (got[0]["item_ids"], got[0]["n_changed"]) == ("1", 0)
    assert (got[1]["item_ids"], got[1]["n_changed"]) == ("1", 1)
    assert not any(got[i]["contaminated"] for i in (3, 4, 5, 6, 7))
    assert held(spark, ["yes", "well yes it is so"], [(4, "Yes.")])[0]["contaminated"]
    assert not held(spark, ["yes", "well yes it is so"], [(4, "Yes.")])[1]["contaminated"]


def test_copies_in_other_case_or_without_punctuation_are_caught(spark):
    bare = re.sub(r"[.,]", "", ITEM)
    title = " ".join(w[:1].upper() + w[1:] for w in ITEM.split(" "))
    around = "and so it was said by many that the thing went on and on without any end in sight "
    copies = [ITEM.upper(), ITEM.lower(), title, bare, bare.upper(), bare.lower()]
    got = held(spark, [*copies, *(around + x + " " + around for x in copies), around.upper(), around.title()], [(1, ITEM)])
    assert [got[i]["item_ids"] for i in range(14)] == ["1"] * 12 + ["", ""]
    assert all(got[i]["n_changed"] == 0 for i in range(12))


def test_renamed_sentence_starts_are_caught(spark):
    item = "Tom has 5 apples. Mary has 3 apples. How many apples do they have together?"
    asked = "Sam has 7 apples. Anna has 4 apples. How many apples do they have together?"
    around = "and so it was said by many that the thing went on and on without any end in sight "
    other = "Sam has 7 pears. Anna sold 4 of these. How much money did they make?"
    got = held(spark, [asked, around + asked + " " + around, around + asked.replace(".", ""), other, around + other, item], [(1, item)])
    assert [got[i]["item_ids"] for i in range(6)] == ["1", "1", "1", "", "", "1"]
    assert [got[i]["n_changed"] for i in range(6)] == [1, 1, 1, 0, 0, 0]


def test_names_at_sentence_starts_must_be_consistent(spark):
    item = "Tom has 5 apples in his bag. Tom eats 3 apples on the way. Tom gives 2 apples to his friend. Tom counts what is left."
    same = item.replace("Tom", "Sam")
    mixed = item.replace("Tom", "Sam", 1).replace("Tom", "Anna", 1).replace("Tom", "Peter", 1).replace("Tom", "Ute", 1)
    got = held(spark, [same, mixed], [(1, item)])
    assert got[0]["contaminated"] and not got[1]["contaminated"]


def test_slots_must_be_consistent(spark):
    item = "if 3 men dig 7 holes then 3 men dig 7 holes and so 3 men dig 7 more holes in all"
    same = "if 4 men dig 9 holes then 4 men dig 9 holes and so 4 men dig 9 more holes in all"
    odd_ = "if 4 men dig 9 holes then 5 men dig 8 holes and so 6 men dig 1 more holes in all"
    got = held(spark, [same, odd_], [(1, item)])
    assert got[0]["contaminated"] and not got[1]["contaminated"]


def test_leaks_of_odd_rows(spark, odd, empty):
    text = odd.where("doc_id = 19").first()["text"]
    bench = spark.createDataFrame([(7, text), (None, text + " more")], "item_id long, text string")
    got = decontam.checked_documents(odd, bench).collect()
    assert len(got) == odd.count() and {r["doc_id"] for r in got if r["contaminated"]} == {19}
    kept = decontam.contaminated_removed(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontam.checked_documents(empty, bench).count() == 0
    assert decontam.contaminated_removed(odd, empty.selectExpr("doc_id as item_id", "text")).count() == odd.count()


def test_leaks_use_no_python(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "benchmark"))
    plan = decontam.checked_documents(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
