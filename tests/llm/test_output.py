"""Token tables, mixing, sharding, URL rules."""

import fnmatch
import functools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from galecast.llm import mix, shard, tokens, urls
from galecast.llm.text import WORD

ODD_WORDS = "It's we'RE a\u00a0b x\x1cy na\u00efve e\u0301t\u00e9 \u01305 \u03a3\u03a3 <|endoftext|> don't! 3.14 (\u00bd) \u00e4\u00d7\u00f6 \u200b # caf\u00e9s \u1e9e".split(" ")


@functools.cache
def tokenizer_of(path):
    return Tokenizer.from_file(path)


def library(text):
    tokenizer = tokenizer_of(tokens.vocabulary())
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_the_library_does():
    coder = tokens.Encoder(tokens.vocabulary())
    assert coder.by_word
    texts = [" ".join(ODD_WORDS), *ODD_WORDS, "", "  a \n b\t"]
    for kept in (tokens.KEPT, 3):
        coder.memory.kept = kept
        for part in (texts, texts[::-1], [], [None, "", None]):
            ids, sizes = coder.encode(pa.array(part, pa.string()), 7)
            assert ids.tolist() == [i for t in part for i in [*library(t), 7]] and sizes.tolist() == [len(library(t)) + 1 for t in part]
    whole = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    assert not whole.by_word
    ids, sizes = whole.encode(pa.array(["a b", None]), 9)
    assert ids.tolist() == [*Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json")).encode("a b").ids, 9, 9] and sizes.tolist() == [len(ids) - 1, 1]


@pytest.mark.parametrize("high", [1, 255, 256, 257, 65536, 1 << 20, 1 << 32])
def test_codes_come_back_and_give_random_access(high):
    random = np.random.default_rng(high)
    for n in (0, 1, 7, 511, 512, 513, 3000):
        ids = (random.integers(0, high, n) >> random.integers(0, 24, n)).astype(np.uint32)
        codes = tokens.pack(ids)
        assert (tokens.tokens(codes, 0, n) == ids).all()
        assert [tokens.token(codes, i) for i in range(n)] == ids.tolist()
        for a, b in random.integers(0, n + 1, (20, 2)):
            assert (tokens.tokens(codes, min(a, b), max(a, b)) == ids[min(a, b) : max(a, b)]).all()


def test_token_table_of_odd_rows(odd, empty):
    rows = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    table = tokens.write_tokens(odd, tokens.vocabulary())
    got = tokens.read_documents(table).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    want = sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in ((i, library(t) + [2]) for i, t in rows))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert tokens.encoded_documents(empty).count() == 0


def test_targets_stop_at_twice_a_source():
    got = mix.targets([("a", 10), ("b", 100), ("c", 100), (None, 50), ("d", 0)])
    assert got["a"] == 20 and got["d"] == 0 and sum(got.values()) == pytest.approx(390)
    assert got["b"] == 200 or got["b"] / 2 == pytest.approx(got["c"])
    assert mix.targets([]) == {} and mix.targets([("a", 0)]) == {"a": 0}


def test_flight_keeps_both_totals():
    random = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 400):
        chance, size = random.random(n), random.integers(0, 50, n).astype(float)
        p = mix.fly(chance, size, random.random(7))
        assert ((p > 0) & (p < 1)).sum() <= 2 and (p >= 0).all() and (p <= 1).all()
        assert p.sum() == pytest.approx(chance.sum(), abs=1e-6) and p @ size == pytest.approx(chance @ size, abs=1e-4)
        done = mix.land(mix.fly(chance, size, random.random(7), mix.LANDING), size)
        assert set(done) <= {0.0, 1.0}


def test_inclusion_is_even(spark):
    """Over many seeds, a document is taken as often as its chance says."""
    docs = spark.createDataFrame([(i, "s", 1 + i % 7) for i in range(30)] + [(100 + i, "t", 3) for i in range(60)], "doc_id long, source string, size long")
    total = np.zeros(30)
    for seed in range(12):
        out = mix.sampled(docs, "size", ["doc_id"], weights=(1, 3), share=0.8, most=1, seed=seed).where("source = 's'").collect()
        total[[r["doc_id"] for r in out]] += [r["copies"] for r in out]
    assert total.mean() / 12 == pytest.approx(0.8 * 0.25 * (sum(1 + i % 7 for i in range(30)) + 180) / sum(1 + i % 7 for i in range(30)), abs=0.05)
    assert total.max() < 12 or total.min() > 0


@pytest.mark.parametrize("group_rows", [4, 4096])
def test_mix_of_the_documents(spark, group_rows):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", mix.words_of("text").alias("size"))
    out = mix.sampled(docs, "size", ["doc_id"], group_rows=group_rows)
    rows = out.toPandas()
    assert len(rows) == 10000 and rows["copies"].between(0, 2).all()
    for _, one in rows.groupby("source"):
        taken, goal = (one["size"] * one["copies"]).sum(), one["target"].iloc[0]
        assert one["source_size"].iloc[0] == one["size"].sum() and abs(taken - goal) < 0.01 * goal
        rate = goal / one["size"].sum()
        assert one["copies"].between(np.floor(rate), np.ceil(rate)).all()
    assert out.exceptAll(mix.sampled(docs.repartition(7), "size", ["doc_id"], group_rows=group_rows)).count() == 0


def test_mix_of_odd_rows(odd, empty):
    got = mix.mixed_documents(odd).collect()
    assert len(got) == odd.count() and all(r["taken"] <= 2 * r["size"] for r in got)
    want = sorted(len(re.findall(WORD, r["text"] or "")) for r in odd.collect())
    assert sorted(r["size"] for r in got) == want
    rows = mix.mixed(odd)
    assert rows.columns == odd.columns
    taken, goal = {}, {r["source"]: r["target"] for r in got}
    for r in rows.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(re.findall(WORD, r["text"] or ""))
    largest = {r["source"]: max(x["size"] for x in got if x["source"] == r["source"]) for r in got}
    assert all(abs(taken.get(s, 0) - goal[s]) <= largest[s] for s in goal)
    copies = {}
    for r in rows.collect():
        copies[str(r)] = copies.get(str(r), 0) + 1
    equal = {}
    for r in odd.collect():
        equal[str(r)] = equal.get(str(r), 0) + 1
    assert all(n <= 2 * equal[r] for r, n in copies.items())
    assert mix.mixed(empty).count() == mix.mixed_documents(empty).count() == 0


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_shards_hold_the_sources_in_proportion(spark, bucket_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "if(doc_id % 3 = 0, null, if(doc_id % 3 = 1, 'a', source)) as source")
    one = lambda d: shard.shards(d, 7, d["source"], d["doc_id"], d["doc_id"], bucket_rows=bucket_rows)
    rows = one(docs).toPandas()
    assert len(rows) == 1000
    assert sorted(rows.groupby("shard").size()) == [142] * 1 + [143] * 6
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    for _, part in rows.fillna("-").groupby("source"):
        counts = part.groupby("shard").size().reindex(range(7), fill_value=0)
        assert counts.max() - counts.min() <= 4
    assert one(docs).exceptAll(one(docs.repartition(5))).count() == 0


def test_shards_of_odd_rows(odd, empty):
    rows = shard.sharded_documents(odd).collect()
    source = odd.collect()
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in source)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots = sorted((r["shard"], r["slot"]) for r in rows)
    assert len(set(slots)) == len(rows) and all(0 <= s < 40 for s, _ in slots)
    assert shard.sharded_documents(empty).count() == 0


URLS = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://a.net/", "http://net/x", "x://m.example.net/en/1?q#z", "http://example.net/en",
        "http://badexample.com/de/", "http://example.com/de/?", "http://b.org/fr/x", "http://borg/fr/", "http://a.example.com/x/a.net/", "http://é.net/ü",
        "http://x.com:80/ads/y", "http://u@h.com/f.exe", "http://h/tracker1.gif", "http://h/tracker.gif", "a://b://c.net/", "http://CASINO.x?y", "http://a.net" + "/a" * 5000]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in urls.HOST_RULES if ("." + host).endswith("." + r[0].split("/", 1)[0]) and path.startswith("/" + r[0].split("/", 1)[1])]
    rule = max(fit, key=lambda r: len(r[0]), default=(None, None))
    whole = f".{host}\n{path}"
    glob = next((g for g in urls.BLOCKED_GLOBS if fnmatch.fnmatchcase(whole, g.replace("|", "\n"))), None)
    return host, path, rule[0], rule[1] or ("block" if glob else "allow"), glob


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    rows = urls.with_verdicts(pages).orderBy("page_id").collect()
    assert [tuple(r[c] for c in ("host", "path", "rule", "verdict", "pattern")) for r in rows] == [plain_verdict(u) for u in URLS]
    assert urls.with_verdicts(pages.limit(0)).count() == 0
    assert [r["verdict"] for r in urls.with_verdicts(pages, rules=(), globs=()).collect()] == ["allow"] * len(URLS)


def test_many_patterns_span_words():
    patterns = [f"*a{'b' * (i % 9)}?c{i}*" for i in range(60)] + ["", "*", "?", "a*b*c", "**x"]
    texts = ["", "a", "abc", "aXc7", "zzabbbXc12yy", "axxbxxc", "x", "qqx", "a" * 200 + "bXc10"]
    got = urls.run(urls.compile_globs([p.encode() for p in patterns]), [t.encode() for t in texts])
    assert got.tolist() == [[fnmatch.fnmatchcase(t, p) for p in patterns] for t in texts]


def test_any_text_encodes_as_the_library_does():
    random = np.random.default_rng(3)
    signs = [chr(c) for c in [*range(1, 0x250), 0x300, 0x301, 0x3A3, 0x4E00, 0x1F600, 0x2019, 0xA0, 0x2028]] + list("abcXYZ0123456789.,!'<|>&# \n") * 6
    samples = ["".join(random.choice(signs, int(random.integers(0, 60)))) for _ in range(2000)] + ["it's a'll 'd !'s <|endoftext|> x<|startoftext|>y O'RE"]
    ids, sizes = tokens.encoder(tokens.vocabulary()).encode(pa.array(samples), 2)
    ends = np.cumsum(sizes)
    assert [ids[a:b].tolist() for a, b in zip(ends - sizes, ends, strict=True)] == [library(t) + [2] for t in samples]
