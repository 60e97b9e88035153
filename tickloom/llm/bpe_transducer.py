"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Merging bytes by rank has a local description. A sequence of tokens is what merging yields exactly if
every token is what merging yields on its own bytes, and no merge crosses the border of two
neighbours when these two stand alone (ranks decide in the same order inside and outside a longer
text). The merges are therefore compiled into a nondeterministic transducer: its state is the last
token and a place in the trie of tokens, and it may close a token where the border holds.

The transducer is determinised while it reads. A state is the set of open readings: for each, its last
token and its place in the trie, all of which are suffixes of the longest. At every place exactly one reading closes a token, which names the
border before it, so the tokens of every prefix are known. A reading stays open only while its place
in the trie has a continuation: readings reach back no further than the longest token, and what all
of them agree on is emitted. States and arcs are found on first use and kept; their table is bounded
and begins anew when it is full, which changes no result.

Decoding joins the bytes of the ids and follows UTF-8 by a state machine, a whole token at a step: what
a token does to the machine's state is kept as well. Characters cut by a border of tokens or of blocks
are held until their last byte; ill-formed sequences become U+FFFD, one for each longest prefix.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import whole_text

_BLOCK = 1 << 16


class State(dict):
    """A determinised state: next state by byte, found on first use.

    ``at`` is the longest open string of the input's end, as its place in the trie; the other open
    ones are its suffixes. ``lasts`` has the last token before each, longest first; the input's end
    itself comes last, so its entry is the token that closes here.
    """

    __slots__ = ("_of", "at", "lasts", "token")

    def __init__(self, of: Transducer, at: int, lasts: tuple[int, ...]):
        self._of, self.at, self.lasts, self.token = of, at, lasts, lasts[-1]

    def __missing__(self, b: int) -> State:
        found = self[b] = self._of.after(self, b)
        return found


class Transducer:
    """Ids of a byte string by the ranks of its tokens, which must include all single bytes."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 1 << 18):
        self.ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._length = {rank: len(token) for token, rank in ranks.items()}
        self._child: dict[int, int] = {}
        #: by place in the trie: the token that ends here, how many bytes lead to it, if it goes on
        self._token, self._depth, self._inner = [-1], [0], [True]
        for token, rank in ranks.items():
            node = 0
            for depth, b in enumerate(token, 1):
                self._inner[node] = True
                node = self._child.setdefault(node << 8 | b, len(self._token))
                if node == len(self._token):
                    self._token.append(-1)
                    self._depth.append(depth)
                    self._inner.append(False)
            self._token[node] = rank
        #: the open places of a longest one, and what a byte does to them
        self._open: dict[int, tuple[int, ...]] = {0: (0,)}
        self._moves: dict[int, tuple] = {}
        self._border: dict[int, bool] = {}
        self._max_states = max_states
        self._states: dict[tuple, State] = {}
        self.start = State(self, 0, (-1,))

    def ids(self, piece: bytes) -> list[int]:
        """A token of the vocabulary stands for itself; other pieces go through the transducer."""
        known = self.ranks.get(piece)
        return [known] if known is not None else self.run(piece)

    def run(self, data: bytes) -> list[int]:
        """Read block by block; what all open readings agree on is emitted after each."""
        state, ends, out = self.start, [], []
        for at in range(0, len(data), _BLOCK):
            for b in data[at : at + _BLOCK]:
                state = state[b]
                ends.append(state.token)
            if at + _BLOCK < len(data):
                agreed = self._agreed(state, ends)
                out += self._tokens(ends, agreed)
                del ends[:agreed]
        return out + self._tokens(ends, len(ends))

    def _tokens(self, ends: list[int], end: int) -> list[int]:
        """The tokens up to ``end``, backwards from the one that was closed there."""
        length, out = self._length, []
        while end:
            token = ends[end - 1]
            out.append(token)
            end -= length[token]
        out.reverse()
        return out

    def _agreed(self, state: State, ends: list[int]) -> int:
        """The last border that lies in all open readings."""
        borders = {len(ends) - self._depth[node] for node in self._open[state.at]}
        while len(borders) > 1:
            last = max(borders)
            borders.remove(last)
            borders.add(last - self._length[ends[last - 1]])
        return borders.pop()

    def after(self, state: State, b: int) -> State:
        edge = state.at << 8 | b
        move = self._moves.get(edge) or self._move(edge)
        at, kept, closing = move
        lasts = state.lasts
        # exactly one reading closes a token at each place
        for i, token in closing:
            if self._holds(lasts[i], token):
                break
        key = at, (*[lasts[i] for i in kept], token)
        found = self._states.get(key)
        if found is None:
            if len(self._states) >= self._max_states:
                for old in self._states.values():
                    old.clear()
                self._states.clear()
                self.start.clear()
            found = self._states[key] = State(self, *key)
        return found

    def _move(self, edge: int) -> tuple[int, list[int], list[tuple[int, int]]]:
        """Longest open place after a byte, which open readings go on, and which may close a token."""
        nodes, kept, closing = [], [], []
        for i, node in enumerate(self._open[edge >> 8]):
            node = self._child.get(node << 8 | edge & 0xFF)
            if node is None:
                continue
            token = self._token[node]
            if token >= 0 and merged(self._bytes[token], self.ranks) == [token]:
                closing.append((i, token))
            if self._inner[node]:
                nodes.append(node)
                kept.append(i)
        nodes.append(0)
        self._open[nodes[0]] = tuple(nodes)
        found = self._moves[edge] = nodes[0], kept, closing
        return found

    def _holds(self, last: int, token: int) -> bool:
        """Whether merging leaves the border between two tokens open."""
        if last < 0:
            return True
        pair = last << 32 | token
        held = self._border.get(pair)
        if held is None:
            if len(self._border) >= 2 * self._max_states:
                self._border.clear()
            both = merged(self._bytes[last] + self._bytes[token], self.ranks)
            held = self._border[pair] = both == [last, token]
        return held


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of least rank, the leftmost first, while any merge; for short strings."""
    never = sys.maxsize
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [ranks.get(a + b, never) for a, b in zip(parts, parts[1:])]  # noqa: B905
    while pairs and (least := min(pairs)) != never:
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], never)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], never)
    return [ranks[p] for p in parts]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Splitter:
    """Pieces of a text by ``pattern``, with the letters and numbers that tiktoken knows.

    The two regular expression engines know different versions of Unicode, so code points on whose
    class they disagree are set apart: each that ``regex`` and the older ``unicodedata`` class
    differently is asked of tiktoken, with a vocabulary in which it can only be one piece or several.
    """

    def __init__(self, pattern: str):
        self._plain = regex.compile(pattern)
        self.apart: list[int] = []
        letters, numbers = (self._foreign(pattern, kind, head) for kind, head in (("L", "a"), ("N", "1")))
        self._odd = regex.compile(f"[{letters}{numbers}]") if letters or numbers else None
        #: no UTF-8 byte of a text reaches this one unless a character could be odd
        self._lead = chr(min(self.apart, default=sys.maxunicode)).encode()[0]
        for kind, odd in (("L", letters), ("N", numbers)):
            if odd:
                inside = rf"\p{{{kind}}}"
                pattern = pattern.replace(f" ?{inside}+", f" ?(?:(?![{odd}]){inside})+")
        other = r"[^\s\p{L}\p{N}]"
        pattern = pattern.replace(f" ?{other}+", f" ?(?:{other}|[{letters}{numbers}])+")
        self._exact = regex.compile(pattern)

    def _foreign(self, pattern: str, kind: str, head: str) -> str:
        import tiktoken

        said = regex.compile(rf"\p{{{kind}}}")
        doubtful = [
            c
            for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)))
            if said.match(c) and unicodedata.category(c)[0] != kind
        ]
        ranks = {bytes([i]): i for i in range(256)}
        for c in doubtful:
            ranks[(head + c).encode()] = len(ranks)
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        odd = [ord(c) for c in doubtful if len(probe.encode_ordinary(head + c)) > 1]
        self.apart += odd
        runs: list[list[int]] = []
        for c in odd:
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in runs)

    def _has_odd(self, text: str) -> bool:
        if self._odd is None or text.isascii():
            return False
        greatest = np.frombuffer(text.encode(), np.uint8).max()
        return bool(greatest >= self._lead and self._odd.search(text))

    def blocks(self, text: str) -> Iterator[list[str]]:
        """The pieces, a bounded number at a time."""
        pattern = self._exact if self._has_odd(text) else self._plain
        if len(text) < 16 * _BLOCK:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while block := list(islice(found, _BLOCK)):
            yield block


class Pieces(dict):
    """Packed ids of the pieces met, short ones kept; begins anew when it is full."""

    def __init__(self, transducer: Transducer, kept: int = 1 << 18, longest: int = 48):
        self._transducer, self._kept, self._longest = transducer, kept, longest

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self._transducer.ids(piece.encode()))
        if sys.byteorder == "big":
            ids.byteswap()
        packed = ids.tobytes()
        if len(piece) <= self._longest:
            if len(self) >= self._kept:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encodes texts to packed little-endian 32-bit ids, and decodes these."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._splitter = Splitter(pattern)
        self._pieces = Pieces(Transducer(ranks))
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._steps: dict[int, int] = {}

    def encode(self, text: str) -> bytes:
        packed = self._pieces.__getitem__
        return b"".join([b"".join(map(packed, block)) for block in self._splitter.blocks(text)])

    def decoder(self) -> Decoder:
        return Decoder(self._bytes, self._steps)

    def decode(self, packed: bytes) -> tuple[str, bool]:
        """The text, and whether all of it was well-formed."""
        decoder, ids = self.decoder(), np.frombuffer(packed, "<u4")
        parts = [decoder.feed(ids[i : i + _BLOCK].tolist()) for i in range(0, len(ids), _BLOCK)]
        parts.append(decoder.finish())
        return "".join(parts), decoder.well_formed


def _machine() -> list[list[int]]:
    """Next state by state and byte; 0 between characters, 8 ill-formed.

    1 to 3 wait for so many continuation bytes; 4 to 7 for those of a first byte E0, ED, F0 or F4,
    of which the next is restricted.
    """
    table = [[8] * 256 for _ in range(9)]

    def put(state: int, low: int, high: int, to: int) -> None:
        for b in range(low, high + 1):
            table[state][b] = to

    for low, high, to in (
        (0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE1, 0xEF, 2), (0xF1, 0xF3, 3),
        (0xE0, 0xE0, 4), (0xED, 0xED, 5), (0xF0, 0xF0, 6), (0xF4, 0xF4, 7),
    ):
        put(0, low, high, to)
    for state, low, high, to in (
        (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2),
        (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2),
    ):
        put(state, low, high, to)
    return table


UTF8 = _machine()
ILL_FORMED = 8


class Decoder:
    """Text from ids given block by block; an id the vocabulary lacks counts as an ill-formed byte."""

    def __init__(self, tokens: dict[int, bytes], steps: dict[int, int] | None = None):
        self._tokens = tokens
        self._steps = {} if steps is None else steps
        self._state, self._held, self.well_formed = 0, b"", True

    def feed(self, ids: list[int]) -> str:
        """The characters that are complete so far."""
        steps, state = self._steps, self._state
        for i in ids:
            step = steps.get(i << 4 | state)
            state = self._step(i, state) if step is None else step
        data = self._held + b"".join([self._tokens.get(i, b"\xff") for i in ids])
        if state == ILL_FORMED:
            return self._mend(data)
        # the bytes of a character that is not complete
        cut = len(data)
        if state:
            cut -= 1
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
        self._state, self._held = state, data[cut:]
        return data[:cut].decode()

    def finish(self) -> str:
        rest = self._mend(self._held) if self._held else ""
        if self._held:
            self.well_formed, self._held, self._state = False, b"", 0
            rest += "�"
        return rest

    def _step(self, i: int, state: int) -> int:
        after = state
        for b in self._tokens.get(i, b"\xff"):
            after = UTF8[after][b]
        self._steps[i << 4 | state] = after
        return after

    def _mend(self, data: bytes) -> str:
        """Byte by byte, with U+FFFD for every longest prefix of a character that breaks off."""
        out, state, first = [], 0, 0
        for at, b in enumerate(data):
            after = UTF8[state][b]
            if after == ILL_FORMED:
                self.well_formed = False
                out.append("�")
                # a byte that breaks a character off may begin another one
                after = UTF8[0][b] if state else ILL_FORMED
                first = at
                if after == ILL_FORMED:
                    if state:
                        out.append("�")
                    after, first = 0, at + 1
            if after == 0:
                out.append(data[first : at + 1].decode())
                first = at + 1
            state = after
        self._state, self._held = state, data[first:]
        return "".join(out)


@lru_cache(maxsize=4)
def codec(name: str) -> Codec:
    """The codec of a vocabulary file, once for each Python worker."""
    import public_tokenizers

    return Codec(read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN)


def encode_texts(docs: DataFrame, tokenizer: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """doc_id and ``ids`` of every whole text, as little-endian unsigned 32-bit integers.

    Each row of ``docs`` gives one row, repeated and null ids included. A null or empty text has no
    ids; strings of special tokens are ordinary text. An empty table gives no rows; columns other
    than doc_id and text are ignored.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = codec(tokenizer).encode
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [encode(x) for x in frame["text"]]})

    # ids travel as text: pandas would turn integers beside nulls into floats
    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    done = narrow.mapInPandas(run, "doc_id string, ids binary")
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def decode_ids(encoded: DataFrame, tokenizer: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """doc_id, ids, the decoded ``text`` and whether it was ``well_formed``.

    Null ids decode as none. Ill-formed bytes and ids beyond the vocabulary become U+FFFD. Columns
    other than doc_id and ids are ignored.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = codec(tokenizer).decode
        for frame in frames:
            done = [decode(x) for x in frame["ids"]]
            yield frame.assign(text=[x for x, _ in done], well_formed=[x for _, x in done])

    narrow = encoded.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids")
    )
    done = narrow.mapInPandas(run, "doc_id string, ids binary, text string, well_formed boolean")
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """``decode_ids`` of ``encode_texts``, both in one Python worker, so ids need not travel between."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = codec(tokenizer)
        for frame in frames:
            # in slices, so that ids and texts of a whole batch are not held twice
            for at in range(0, len(frame), 512):
                part = frame.iloc[at : at + 512]
                ids = [made.encode(x) for x in part["text"]]
                done = [made.decode(x) for x in ids]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(), "ids": ids,
                        "text": [x for x, _ in done], "well_formed": [x for _, x in done],
                    }
                )

    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    done = narrow.mapInPandas(run, "doc_id string, ids binary, text string, well_formed boolean")
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def digest(decoded: DataFrame) -> DataFrame:
    """Counts and hashes of ids and decoded text, one row for each of ``decode_ids``."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
