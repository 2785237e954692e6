"""URL rules: glob patterns packed into the bits of Shift-And masks and run over all URLs of a batch at once.

The canonical form of a URL is "." + host + SEPARATOR + path. SEPARATOR is a byte that UTF-8 never holds, so a pattern tells
host from path, and a leading "*." means the host itself and all its subdomains. In a pattern `*` stands for any bytes, `?` for
one byte, `|` for the separator; every other character stands for itself. A pattern must fit the whole canonical form.

All patterns live in one row of 64-bit words, one bit for each state; a step shifts every state along by one, keeps those that
read the byte, and keeps a state before `*` where it is. So the cost of a URL is its length times the number of words, however
many patterns there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEPARATOR = 0xFF
#: Fixed values: (rule, verdict); a rule is a host and a path, it holds for subdomains and for paths that start with its own.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Patterns on the canonical form that block where no host rule fits.
BLOCKED_GLOBS = ("*casino*|*", "*free-bets*|*", "*cheap-pills*|*", "*ads-track*|*", "*|*/ads/*", "*|*.exe", "*|*tracker?.gif")
COLUMNS = "host string, path string, rule string, verdict string, pattern string"
#: URLs stepped together; bounds the memory of a pass.
PASS_URLS = 16384


class Automaton(NamedTuple):
    masks: np.ndarray  # (256, words): states that are entered by a byte
    stay: np.ndarray  # (words,): states that any byte keeps
    begin: np.ndarray  # (words,): states before the first byte
    enter: np.ndarray  # (words,): first states, where the shift must not carry in from the pattern before
    final: np.ndarray  # (patterns, 2): word and bit of each pattern's last state


def compile_globs(patterns: list[bytes]) -> Automaton:
    """State 0 of a pattern is before its first symbol, state i after the i-th symbol other than `*`."""
    masks: list[tuple[int, int | None]] = []
    stay, first, final, n = [], [], [], 0
    for pattern in patterns:
        first.append(n)
        for symbol in pattern:
            if symbol == ord("*"):
                stay.append(n)
            else:
                n += 1
                masks.append((n, None if symbol == ord("?") else SEPARATOR if symbol == ord("|") else symbol))
        final.append(n)
        n += 1
    size = n // 64 + 1
    table, kept, begin = np.zeros((256, size), np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
    bit = lambda k: np.uint64(1 << (k % 64))
    for k, symbol in masks:
        for byte in range(256) if symbol is None else (symbol,):
            if symbol is not None or byte != SEPARATOR:
                table[byte, k // 64] |= bit(k)
    for k in stay:
        kept[k // 64] |= bit(k)
    for k in first:
        begin[k // 64] |= bit(k)
    return Automaton(table, kept, begin, ~begin, np.array([(k // 64, k % 64) for k in final], np.int64).reshape(-1, 2))


def run(automaton: Automaton, urls: list[bytes]) -> np.ndarray:
    """(urls, patterns): which pattern fits which whole URL. Longest first, so that finished URLs leave the pass."""
    size = np.array([len(u) for u in urls], np.int64)
    order = np.argsort(-size, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(b"".join(urls), np.uint8)
    state = np.repeat(automaton.begin[None, :], len(urls), axis=0)
    one, top = np.uint64(1), np.uint64(63)
    begins, lengths = offsets[:-1][order], size[order]
    active = len(urls)
    for i in range(int(size.max()) if len(urls) else 0):
        while active and lengths[active - 1] <= i:
            active -= 1
        now = state[:active]
        shifted = now << one
        shifted[:, 1:] |= now[:, :-1] >> top
        state[:active] = (shifted & automaton.enter & automaton.masks[data[begins[:active] + i]]) | (now & automaton.stay)
    hit = (state[:, automaton.final[:, 0]] >> automaton.final[:, 1].astype(np.uint64)) & one
    out = np.zeros(hit.shape, bool)
    out[order] = hit.astype(bool)
    return out


def host_glob(rule: str) -> str:
    host, slash, path = rule.partition("/")
    return f"*.{host}|{slash}{path}*"


def encode(pattern: str) -> bytes:
    return pattern.encode()


def parts(url: str) -> list:
    """Host (lower-cased A-Z) and path as column expressions; both empty for a null or a text without `://`."""
    rest = f"substring(`{url}`, instr(`{url}`, '://') + 3)"
    known = f"coalesce(instr(`{url}`, '://') > 0, false)"
    host = F.translate(F.expr(f"if({known}, regexp_extract({rest}, '^[^/?#]*', 0), '')"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.expr(f"if({known}, regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')")
    return [host.alias("host"), path.alias("path")]


def with_verdicts(pages: DataFrame, url: str = "url", rules: tuple = HOST_RULES, globs: tuple = BLOCKED_GLOBS) -> DataFrame:
    """Every row of pages with host, path, the longest fitting host rule, the verdict and the first fitting pattern.

    Host rules and patterns run in one automaton. A URL that no rule and no pattern fits is allowed; so is a null URL, an empty
    one, or one without `://`, whose host and path are empty. Columns of pages with the names of COLUMNS are replaced. No shuffle.
    """
    ranked = sorted(rules, key=lambda rule: -len(rule[0]))
    automaton = compile_globs([encode(host_glob(rule)) for rule, _ in ranked] + [encode(glob) for glob in globs])
    names = np.array([rule for rule, _ in ranked] + [None], object)
    verdicts = np.array([verdict for _, verdict in ranked] + ["allow"], object)
    patterns = np.array([*globs, None], object)
    added = [part.split()[0] for part in COLUMNS.split(", ")]
    kept = [name for name in pages.columns if name not in added]
    split = pages.select(*(F.col(f"`{name}`") for name in kept), *parts(url))

    def first(hit: np.ndarray) -> np.ndarray:
        return np.where(hit.any(axis=1), hit.argmax(axis=1), hit.shape[1]) if hit.shape[1] else np.zeros(len(hit), np.int64)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PASS_URLS):
                part = batch.slice(begin, PASS_URLS)
                pairs = zip(part.column("host").to_pylist(), part.column("path").to_pylist(), strict=True)
                hit = run(automaton, [b"." + host.encode() + bytes([SEPARATOR]) + path.encode() for host, path in pairs])
                rule, glob = first(hit[:, : len(ranked)]), first(hit[:, len(ranked) :])
                verdict = np.where(rule < len(ranked), verdicts[rule], np.where(glob < len(globs), "block", "allow"))
                extra = [pa.array(x, pa.string()) for x in (names[rule], verdict, patterns[glob])]
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[*kept, *added])

    return split.mapInArrow(judge, StructType([*split.schema.fields, *StructType.fromDDL(COLUMNS).fields[2:]]))
