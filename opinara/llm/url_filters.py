"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed into one row of 64-bit words, one bit per state, and
every canonical URL (lower-case host, then path) runs through all of them at
once, byte by byte: ``state = (state << 1) & literal[byte] | state & loop[byte]``.
Globs: ``*`` is any run without a slash, ``**`` any run, ``?`` one byte but a slash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict): a rule fits its host and all subdomains when the path starts with the rule's.
HOST_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Globs that block a URL no host rule decides; all other URLs are allowed.
BLOCK_GLOBS = ["**cheap-pills**", "**free-bets**", "**spam-farm**", "**ads-track**", "**/casino/**", "*/**.exe"]


class GlobAutomaton:
    """Multiword Shift-And over a list of globs."""

    def __init__(self, globs: Sequence[str]):
        parsed = [self._parse(g.encode()) for g in globs]
        bits = sum(len(literals) + 1 for literals, _ in parsed)
        self.words = max(1, -(-bits // 64))
        self.literal = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final = []
        at = 0
        for literals, stars in parsed:
            self.start[at >> 6] |= self._bit(at)
            for j, allowed in enumerate(literals):
                self.literal[allowed, (at + j + 1) >> 6] |= self._bit(at + j + 1)
            for j, allowed in stars:
                self.loop[allowed, (at + j) >> 6] |= self._bit(at + j)
            at += len(literals)
            self.final.append(at)
            at += 1

    @staticmethod
    def _bit(at: int) -> np.uint64:
        return np.uint64(1 << (at & 63))

    @staticmethod
    def _parse(glob: bytes):
        """The byte sets to read in turn, and (number read so far, bytes that a star there may eat)."""
        no_slash = np.arange(256) != ord("/")
        literals, stars, i = [], [], 0
        while i < len(glob):
            if glob[i:i + 2] == b"**":
                stars.append((len(literals), np.ones(256, bool)))
                i += 2
                continue
            if glob[i:i + 1] == b"*":
                stars.append((len(literals), no_slash))
            elif glob[i:i + 1] == b"?":
                literals.append(no_slash)
            else:
                literals.append(np.arange(256) == glob[i])
            i += 1
        return literals, stars

    def matches(self, urls: Sequence[bytes]) -> np.ndarray:
        """One boolean row per URL, one column per glob."""
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        data = np.frombuffer(b"".join(urls), np.uint8)
        order = np.argsort(-lengths, kind="stable")
        offsets = (np.cumsum(lengths) - lengths)[order]
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        state = np.tile(self.start, (len(urls), 1))
        for i, k in enumerate(active):  # the first k URLs, longest first, have a byte i
            now, byte = state[:k], data[offsets[:k] + i]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:k] = (moved & self.literal[byte]) | (now & self.loop[byte])
        out = np.empty((len(urls), len(self.final)), bool)
        for g, bit in enumerate(self.final):
            out[order, g] = (state[:, bit >> 6] & self._bit(bit)) != 0
        return out


@dataclass
class UrlRules:
    """Host rules, decided by the longest, then blocking globs."""

    host_rules: Sequence[tuple[str, str, str]]
    block_globs: Sequence[str]

    def __post_init__(self):
        # Longest first; of equal length the one listed first.
        self.ranked = sorted(self.host_rules, key=lambda r: -len(r[0] + r[1]))
        hosts = [f"{prefix}{host}{path}**" for host, path, _ in self.ranked for prefix in ("", "*.")]
        self.automaton = GlobAutomaton([*hosts, *self.block_globs])

    def judge(self, urls: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index into ``ranked`` (or -1), and of the first blocking glob (or -1)."""
        hit = self.automaton.matches(urls)
        n = len(self.ranked)
        rules = hit[:, 0:2 * n:2] | hit[:, 1:2 * n:2]
        first = lambda m: np.where(m.any(1), m.argmax(1), -1) if m.shape[1] else np.full(len(m), -1)
        return first(rules), first(hit[:, 2 * n:])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lowered; path: then up to ? or #. Else both empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def judge_urls(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
               host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
               block_globs: Sequence[str] = BLOCK_GLOBS) -> DataFrame:
    """``id, host, path, rule, glob, verdict`` per row, without a shuffle.

    ``rule`` is the longest fitting host rule (host + path) or null, ``glob`` the
    first blocking glob that matches or null. The verdict is the rule's, else
    block if a glob matched, else allow. A null URL or one without ``://`` has
    empty host and path and is allowed unless a glob matches the empty text. Rows
    are judged one by one: repeated, very long and null-id rows are kept as they
    are, an empty table gives none, other columns are ignored.
    """
    rules = UrlRules(list(host_rules), list(block_globs))

    def judged(host: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in host:
            rule, glob = rules.judge([(h + p).encode() for h, p in zip(hosts, paths)])
            yield pd.DataFrame({"rule": rule.astype("int32"), "glob": glob.astype("int32")})

    judged = F.pandas_udf(judged, "rule int, glob int")
    url = F.col(url_column)
    host, path = host_and_path(url)
    found = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    found = found.withColumn("hit", judged("host", "path"))
    pick = lambda names, i: F.get(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"), i)
    rule = pick([h + p for h, p, _ in rules.ranked], F.col("hit.rule"))
    glob = pick(rules.block_globs, F.col("hit.glob"))
    verdict = F.coalesce(pick([v for _, _, v in rules.ranked], F.col("hit.rule")),
                         F.when(F.col("hit.glob") >= 0, "block").otherwise("allow"))
    return found.select("id", "host", "path", rule.alias("rule"), glob.alias("glob"), verdict.alias("verdict"))
