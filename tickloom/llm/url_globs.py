"""URL filter: every glob rule is simulated at once by one bit-parallel automaton.

Rules are packed side by side into multiword Shift-And masks. A rule with m characters takes m + 1
bits: bit i says that its first i characters are matched. One step moves all rules over one
character:

    state = ((state << 1) & takes[c]) | (state & stays[c])

``takes`` has the bits whose character is c, ``stays`` those before a wildcard that may swallow c.
The bit that starts a rule is never taken, so nothing leaks from one rule into the next. A batch of
URLs is stepped together; longer ones stay in the batch until their own end.

Wildcards: ``?`` one character but ``/``; ``*`` any run without ``/``; ``**`` any run; a backslash
quotes the next character. A rule fits the whole canonical URL, which is ``.`` + host + path with
the host lower-cased, without scheme, query and fragment.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, UPPER

WORD = 64


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and all its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return "*." + quote(self.host) + quote(self.path) + "**"


#: The rules that come before the globs.
HOST_RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)

#: Host labels and paths of pages that are not wanted in a corpus.
BLOCK_GLOBS = (
    "*.casino-**", "*.casino.**", "*.adult-**", "*.adult.**", "*.cheap-pills**", "*.free-bets**",
    "*.spam-**", "*.ads-**", "*.ads.**", "*.ad?.**", "*.xxx/**", "**/casino/**", "**/adult/**",
)


def quote(text: str) -> str:
    return "".join("\\" + c if c in "\\*?" else c for c in text)


class Automaton:
    """The masks of a list of globs."""

    def __init__(self, globs: Sequence[str]):
        parsed = [self._parse(g) for g in globs]
        chars = sorted({ord(c) for tokens, _ in parsed for c in tokens if len(c) == 1} | {ord("/")})
        self.chars = np.array(chars, dtype=np.uint32)  # class 0 is any other character
        bits = sum(len(tokens) + 1 for tokens, _ in parsed)
        self.words = max(1, -(-bits // WORD))
        classes = len(chars) + 1
        self.takes = np.zeros((classes, self.words), np.uint64)
        self.stays = np.zeros((classes, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        slash = chars.index(ord("/")) + 1
        at = 0
        for tokens, loops in parsed:
            self._set(self.start, at)
            for i, token in enumerate(tokens):
                for k in range(classes):
                    if (token == "any" and k != slash) or (k and token == chr(chars[k - 1])):
                        self._set(self.takes[k], at + i + 1)
            for i, kind in loops.items():
                for k in range(classes):
                    if kind == "**" or k != slash:
                        self._set(self.stays[k], at + i)
            last = at + len(tokens)
            self.ends.append((last // WORD, np.uint64(1) << np.uint64(last % WORD)))
            at = last + 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // WORD] |= np.uint64(1) << np.uint64(bit % WORD)

    @staticmethod
    def _parse(glob: str) -> tuple[list[str], dict[int, str]]:
        tokens: list[str] = []
        loops: dict[int, str] = {}
        i = 0
        while i < len(glob):
            c = glob[i]
            if c == "*":
                wide = glob[i : i + 2] == "**"
                if wide or loops.get(len(tokens)) != "**":
                    loops[len(tokens)] = "**" if wide else "*"
                i += 2 if wide else 1
                continue
            if c == "\\" and i + 1 < len(glob):
                i += 1
                tokens.append(glob[i])
            else:
                tokens.append("any" if c == "?" else c)
            i += 1
        return tokens, loops

    def run(self, texts: Sequence[str]) -> np.ndarray:
        """A boolean row for each text, a column for each glob."""
        n = len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.searchsorted(self.chars, codes)
        place[place == len(self.chars)] = 0
        kinds = np.where(self.chars[place] == codes, place + 1, 0)
        starts = (np.cumsum(lengths) - lengths)[order]
        state = np.tile(self.start, (n, 1))
        sizes = lengths[order]
        alive = n
        for step in range(int(sizes[0]) if n else 0):
            while alive and sizes[alive - 1] <= step:
                alive -= 1
            kind = kinds[starts[:alive] + step]
            now = state[:alive]
            moved = now << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(WORD - 1)
            state[:alive] = (moved & self.takes[kind]) | (now & self.stays[kind])
        found = np.zeros((n, len(self.ends)), bool)
        for k, (word, bit) in enumerate(self.ends):
            found[order, k] = (state[:, word] & bit) != 0
        return found


def canonical(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, host and path. A null URL or one without ``://`` has both empty."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(
        F.col(key),
        F.translate(F.regexp_extract(url, shape, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, shape, 2).alias("path"),
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[HostRule] = HOST_RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
    key: str = "page_id",
) -> DataFrame:
    """Verdict of every page, one row per input row.

    Columns: ``key``, host, path, rule (text of the longest host rule that fits, else null), verdict
    (that rule's; else ``block`` if any glob fits, else ``allow``), n_globs (globs that fit). Null or
    malformed URLs fit no host rule and are allowed unless a glob takes the lone dot. An empty table
    gives no rows; other columns of ``pages`` are ignored. Among host rules of equal length the
    first listed wins.
    """
    ranked = sorted(rules, key=lambda r: -len(r.text))
    globs = [r.glob for r in ranked] + list(block_globs)
    kind = pages.schema[key].dataType.simpleString()

    def judge(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(globs)
        for frame in frames:
            fits = automaton.run(("." + frame["host"] + frame["path"]).tolist())
            host, extra = fits[:, : len(ranked)], fits[:, len(ranked) :]
            first = np.where(host.any(axis=1), host.argmax(axis=1) if len(ranked) else 0, -1)
            n_globs = extra.sum(axis=1)
            yield frame.assign(
                rule=[ranked[k].text if k >= 0 else None for k in first],
                verdict=[
                    ranked[k].verdict if k >= 0 else "block" if n else "allow"
                    for k, n in zip(first, n_globs, strict=True)
                ],
                n_globs=n_globs.astype("int64"),
            )

    return canonical(pages, key).mapInPandas(
        judge,
        f"`{key}` {kind}, host string, path string, rule string, verdict string, n_globs bigint",
    )
