"""Manifest, packing and conversation repair against plain versions."""

import itertools
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from tokenizers import Tokenizer

from galecast.llm import conversations, merkle, packing, tokens

SF = "/root/testdata/sf0.001"


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in merkle.FIELDS)))


def plain_tree(nodes):
    """All levels, from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def plain_proof(levels, i):
    out = []
    for level in levels[:-1]:
        out += [level[i ^ 1]] if i ^ 1 < len(level) else []
        i >>= 1
    return out


def plain_fold(leaf, levels, i, siblings):
    for level in levels[:-1]:
        if i ^ 1 < len(level):
            beside = siblings.pop(0)
            leaf = digest(beside + leaf if i & 1 else leaf + beside)
        else:
            leaf = digest(leaf)
        i >>= 1
    return leaf


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r))) for g in order}
    levels = {g: plain_tree([plain_leaf(r) for r in trees[g]]) for g in order}
    top = plain_tree([levels[g][-1][0] for g in order]) if order else []
    out = []
    for t, g in enumerate(order):
        for i, row in enumerate(trees[g]):
            siblings = plain_proof(levels[g], i) + plain_proof(top, t)
            shown = dict(row.asDict())
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None:
                shown["n_chars"] += 1
            left = list(siblings)
            end = plain_fold(plain_fold(plain_leaf(shown), levels[g], i, left), top, t, left)
            out.append((row["doc_id"], plain_leaf(row), levels[g][-1][0], top[-1][0], digest("".join(siblings)), end, end == top[-1][0]))
    return out


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("every", [1, 2, 10])
def test_manifest_of_odd_rows(odd, empty, every):
    got = merkle.verified_documents(odd, every).collect()
    want = plain_manifest(odd.collect())
    assert sorted(tuple(r[c] for c in PROOF) for r in got if r["doc_id"] is not None) == sorted(r for r in want if r[0] is not None)
    assert sorted(tuple(r[c] for c in PROOF[1:]) for r in got) == sorted(r[1:] for r in want)
    assert any(r["verified"] for r in got) and not all(r["verified"] for r in got)
    assert merkle.verified_documents(empty, every).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 33])
def test_trees_of_any_size(spark, n):
    rows = [(i, f"t{i}", "l" if i else "m", None, i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.manifest(docs, every=2)
    assert [sorted(r["pos"] for r in level.where("tree = '=l'").collect()) for level in made.groups] == [
        list(range(-(-(n - 1) // 4**i))) for i in range(len(made.groups))
    ]
    got = merkle.verified_documents(docs, 2).collect()
    assert sorted(tuple(r[c] for c in PROOF) for r in got) == sorted(plain_manifest(docs.collect()))


def test_manifest_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = merkle.verified_documents(docs).collect()
    assert sorted(tuple(r[c] for c in PROOF) for r in got) == sorted(plain_manifest(docs.collect()))


def bins_of(runs):
    bins = {}
    for run in runs:
        assert run.count and run.each
        for i in range(run.count):
            bins.setdefault(run.sequence + i // run.each, []).append((run.offset + i % run.each * run.length, run.length))
    return bins


def best_fit_decreasing(counts, capacity):
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((g for g in gaps if g >= length), default=None)
            if fit is None:
                gaps.append(capacity - length)
            else:
                gaps[gaps.index(fit)] -= length
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_plan_fills_bins(seed):
    random = np.random.default_rng(seed)
    capacity = int(random.integers(5, 80))
    lengths = random.integers(1, capacity + 1, int(random.integers(1, 400))) if seed % 3 else np.minimum(random.geometric(0.1, 500), capacity)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    runs = packing.plan(counts, capacity)
    for length, n in counts.items():
        mine = sorted(r for r in runs if r.length == length)
        assert [r.first for r in mine] == list(itertools.accumulate([0] + [r.count for r in mine[:-1]])) and sum(r.count for r in mine) == n
    bins = bins_of(runs)
    assert sorted(bins) == list(range(len(bins)))
    for items in bins.values():
        items.sort()
        assert [a for a, _ in items] == list(itertools.accumulate([0] + [n for _, n in items[:-1]])) and sum(n for _, n in items) <= capacity
    large = sum(1 for items in bins.values() if any(3 * n > capacity for _, n in items))
    assert all(sum(3 * n > capacity for _, n in items) <= 2 for items in bins.values())
    assert len(bins) <= best_fit_decreasing(counts, capacity) and len(bins) >= -(-int(lengths.sum()) // capacity)
    assert large >= -(-sum(n for length, n in counts.items() if 3 * length > capacity) // 2)


def test_large_items_are_matched_as_often_as_they_can():
    random = np.random.default_rng(5)
    for _ in range(60):
        items = sorted(random.integers(7, 20, 7).tolist())
        counts = {n: items.count(n) for n in items}

        def pairs(rest):
            if not rest:
                return 0
            return max([pairs(rest[1:])] + [1 + pairs(rest[1:i] + rest[i + 1 :]) for i in range(1, len(rest)) if rest[0] + rest[i] <= 20])

        assert len(bins_of(packing.plan(counts, 20))) == len(items) - pairs(items)


def test_plan_of_many_documents_is_short():
    counts = {n: 10**9 // n + n % 7 for n in range(1, 2049)}
    runs = packing.plan(counts)
    assert len(runs) < 60_000
    tokens_ = sum(n * k for n, k in counts.items())
    assert max(r.sequence + -(-r.count // r.each) for r in runs) <= 1.001 * tokens_ / 2048


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    out = []
    for row in rows:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        for i in range(0, len(ids), capacity):
            part = np.array(ids[i : i + capacity], "<u4").tobytes()
            out.append((str(row["doc_id"]), i // capacity, i, len(part) // 4, zlib.crc32(part)))
    return sorted(out)


@pytest.mark.parametrize("capacity", [5, 2048])
def test_packing_of_odd_rows(odd, empty, capacity):
    sequences = packing.packed(odd, capacity=capacity)
    got = packing.pieces_of(sequences).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == plain_pieces(odd.collect(), capacity)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [a for a, _ in items] == list(itertools.accumulate([0] + [n for _, n in items[:-1]])) and sum(n for _, n in items) <= capacity
    counts = {}
    for r in got:
        counts[r["length"]] = counts.get(r["length"], 0) + 1
    assert len(bins) <= best_fit_decreasing(counts, capacity) if capacity > 5 else True
    assert sequences.count() == len(bins) and packing.packed_documents(empty).count() == 0


# ---- conversations --------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = {}
    for row in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(row['conv_id'])}:{show(row['turn'])}".encode()) % 20
        mine = out.setdefault(row["conv_id"], [])
        role, text = ("user" if kind == 4 else show(row["role"])), show(row["text"])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(row["turn"], role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_order(rows):
    key = lambda r: sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key(r)))


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    return faults


def plain_repair(rows, faults):
    """The cheapest and ASCII-least audit by search over whole audits: (cost, audit, repaired lines)."""
    after = {"": ("u", "s"), "s": ("u",), "u": ("a",), "a": ("u",)}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserts(states):
        grown = dict(states)
        for _ in range(3):
            for place, (cost, audit, lines) in list(grown.items()):
                to = after[place][0]
                new = (cost + 5, audit + "I", lines + (f"{names[to]}:",))
                if to not in grown or new[:2] < grown[to][:2]:
                    grown[to] = new
        return grown

    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def offer(place, cost, audit, lines):
            if place not in new or (cost, audit) < new[place][:2]:
                new[place] = (cost, audit, lines)

        for place, (cost, audit, lines) in inserts(best).items():
            offer(place, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            stay = 5 if fault == "truncated" else 0
            if role[:1] in after[place]:
                offer(role[:1], cost + stay, audit + "K", lines + (f"{role}:{text}",))
            to = after[place][0]
            offer(to, cost + 1 + stay, audit + "R", lines + (f"{names[to]}:{text}",))
        best = new
    return min(v for k, v in inserts(best).items() if k in ("", "a"))


def plain_conversations(rows):
    out = []
    for conv, mine in plain_damage(rows).items():
        mine = plain_order(mine)
        faults = plain_faults(mine)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = plain_repair(mine, faults)
        out.append((str(conv), gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest("\n".join(lines))))
    return sorted(out)


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found_conversations(df):
    return sorted((str(r["conv_id"]), *(r[c] for c in RESULT)) for r in df.collect())


def odd_conversations(seed, n=60):
    random = np.random.default_rng(seed)
    texts = [None, "", " \n", "yes.", "no", "why?", "é!  ", "x. y", "same.", "long " * 300]
    roles = ["user", "assistant", "system", None, "", "tool", "usher", "User"]
    out = []
    for conv in range(n):
        for turn in range(int(random.integers(0, 9))):
            at = None if random.random() < 0.08 else int(turn + (random.random() < 0.1))
            role = roles[int(random.integers(0, 2))] if random.random() < 0.8 else roles[int(random.integers(0, len(roles)))]
            out.append((conv if conv else None, at, role, texts[int(random.integers(0, len(texts)))], "x", 1))
    return out + out[:7] + [(900, None, "user", "hi.", "x", 1)] * 9 + [(901, 5, "user", "a.", "y", 1)]


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_repair_of_odd_conversations(spark, block):
    rows = spark.createDataFrame(odd_conversations(block), "conv_id long, turn long, role string, text string, conv string, head int").repartition(5)
    fixed = conversations.repaired(conversations.damaged(rows), block)
    named = fixed.selectExpr("if(conv = '', null, substring(conv, 2)) AS conv_id", *RESULT)
    assert found_conversations(named) == plain_conversations(rows.collect())
    assert conversations.repaired_conversations(rows.limit(0)).count() == 0


def test_repair_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        random = np.random.default_rng(3)
        rows = [(1, i, "user" if random.random() < 0.6 else "assistant", f"t{int(random.integers(0, 150))}.") for i in range(400)]
        rows += [(2, i % 50, "user", "again.") for i in range(300)]
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
        fixed = conversations.repaired(conversations.damaged(table), 16)
        named = fixed.selectExpr("substring(conv, 2) AS conv_id", *RESULT)
        assert found_conversations(named) == plain_conversations(table.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repair_of_the_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found_conversations(conversations.repaired_conversations(rows)) == plain_conversations(rows.collect())
