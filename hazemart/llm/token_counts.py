"""Exact token counts of byte-level BPE by dynamic programming over prefixes.

The text is split as the tokenizer splits it. Within a piece the encoding of every prefix ends in
exactly one token: the one that stands after the shorter prefix without being merged with it. So
``count[i] = count[i - len(token)] + 1``, and one pass stores the exact token count of every prefix
of the piece. Over the text the counts at piece boundaries are running sums. Together they answer
how many tokens any prefix has and how long a prefix fits a budget, without encoding again.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import sys
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel

#: what a task remembers: so many pieces of at most so many characters, and so many pairs of tokens; the rest is counted anew
CACHED_PIECES, CACHED_LENGTH, CACHED_PAIRS = 400_000, 64, 400_000

# White space as the tokenizer's pattern has it (fixed values).
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def _class(kinds: tuple[str, ...], low: int, high: int) -> str:
    """Ranges of a character class for the characters of some categories, from the character database."""
    runs: list[list[int]] = []
    for code in range(low, high):
        if unicodedata.category(chr(code)) in kinds:
            if runs and code == runs[-1][1] + 1:
                runs[-1][1] = code
            else:
                runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


@functools.cache
def piece_pattern(wide: bool = True) -> re.Pattern:
    """The split of the tokenizer: letters, contractions, numbers, other signs, white space.

    Without ``wide`` it is right, and faster, for texts without characters beyond the first plane.
    """
    letters, numbers = ("Lu", "Ll", "Lt", "Lm", "Lo"), ("Nd", "Nl", "No")
    low = [_class(kinds, 0, 1 << 16) for kinds in (letters, numbers)]
    runs = [f"[{c}]+" for c in low]
    signs = f"[^{_SPACE}{''.join(low)}]+"
    if wide:
        high = [_class(kinds, 1 << 16, sys.maxunicode + 1) for kinds in (letters, numbers)]
        runs = [f"(?:[{a}]+|[{b}]+)+" for a, b in zip(low, high, strict=True)]
        signs = f"(?:(?![{''.join(high)}])[^{_SPACE}{''.join(low)}])+"
    return re.compile(
        f" ?{runs[0]}|'(?:s|t|re|ve|m|ll|d)| ?{runs[1]}| ?{signs}|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    )


def pieces_of(text: str) -> re.Pattern:
    plain = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return piece_pattern(not plain)


def _alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class PrefixCounter:
    """Token counts at every prefix for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], _alphabet()
        as_bytes = lambda token: "".join(chr(alphabet[c]) for c in token)  # noqa: E731  bytes as Latin-1
        self._ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._ranks[as_bytes(left), as_bytes(right)] = rank
        self._ends = ahocorasick.Automaton()
        for token in model["vocab"]:
            self._ends.add_word(as_bytes(token), as_bytes(token))
        self._ends.make_automaton()
        self._pairs: dict[tuple[str, str], bool] = {}
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._totals = _Totals(self)

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self._ranks.get(pair, sys.maxsize), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == sys.maxsize:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` stand side by side unmerged."""
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            found = self._pairs[left, right] = self._merged(left + right) == ([left, right] if left else [right])
        return found

    def piece_prefixes(self, piece: str) -> list[int]:
        """Token counts of the prefixes of one piece, by UTF-8 length; index 0 is the empty prefix."""
        text = piece.encode("utf-8").decode("latin-1")
        last, count = [""] * (len(text) + 1), [0] * (len(text) + 1)
        done, stays = 0, self._pairs
        for end, token in self._ends.iter(text):
            end += 1
            if end == done:
                continue
            start = end - len(token)
            before = last[start]
            known = stays.get((before, token))
            if known if known is not None else self._stays(before, token):
                last[end], count[end], done = token, count[start] + 1, end
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pattern, totals = pieces_of(text), self._totals.__getitem__
        if self._special is not None and (parts := self._special.split(text))[1:]:
            return len(parts) - 1 + sum(sum(map(totals, pattern.findall(p))) for p in parts)
        return sum(map(totals, pattern.findall(text)))

    def boundaries(self, text: str | None) -> tuple[list[int], list[int]]:
        """Character ends of the pieces of ``text`` and the token count of the prefix up to each."""
        text = text or ""
        ends, counts, at = [0], [0], 0
        pattern = pieces_of(text)
        cuts = [m.span() for m in self._special.finditer(text)] if self._special is not None else []
        for start, stop in [*cuts, (len(text), None)]:
            for piece in pattern.findall(text[at:start]):  # a part between special tokens is a text of its own
                ends.append(ends[-1] + len(piece))
                counts.append(counts[-1] + self._totals[piece])
            if stop is not None:
                ends.append(stop)
                counts.append(counts[-1] + 1)
                at = stop
        return ends, counts

    def count_at(self, text: str, length: int, stored: tuple[list[int], list[int]]) -> int:
        """Tokens of ``text[:length]`` from the stored counts; only the last pieces are looked at again.

        A cut can change the piece it falls into and the one before (a run of white space, the signs
        before a special token), so those are read again.
        """
        ends, counts = stored
        k = max(0, bisect.bisect_left(ends, length) - 2)
        while k and (text[ends[k] - 1].isspace() or text[ends[k] : length].isspace()):
            k -= 1
        return counts[k] + self.count(text[ends[k] : length])

    def longest_prefix(self, text: str, budget: int, stored: tuple[list[int], list[int]]) -> int:
        """The most characters whose prefix has at most ``budget`` tokens and stays within it up to there."""
        ends, counts = stored
        k = bisect.bisect_right(counts, budget) - 1
        best = ends[k]
        stop = ends[k + 1] if k + 1 < len(ends) else best
        while best < stop and self.count_at(text, best + 1, stored) <= budget:
            best += 1
        return best


class _Totals(dict):
    """Token count per piece; long pieces are not kept and it is emptied when full, so a task's memory is bounded."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self._counter = counter

    def __missing__(self, piece: str) -> int:
        total = self._counter.piece_prefixes(piece)[-1]
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = total
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent: repeated rows give equal
    results, a null id is carried along, other columns are not read, an empty table gives no rows.
    Nothing is shuffled.
    """
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = counter(tokenizer).count
        texts = batch.column("_text").to_pylist()
        tokens = np.fromiter(map(of, texts), np.int64, len(texts))
        _, offsets = kernel.text_bytes(batch.column("_text"))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], names=schema.names
        )

    return kernel.arrow_map(docs.select(F.col(id_col), F.col(text_col).alias("_text")), count, schema, "_text")


def prefix_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored counts: id, ends (characters) and tokens (count of the prefix up to each end), both from 0."""
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ])

    def store(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [counter(tokenizer).boundaries(text) for text in batch.column("_text").to_pylist()]
        kind = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([e for e, _ in found], kind), pa.array([c for _, c in found], kind)], names=schema.names
        )

    return kernel.arrow_map(docs.select(F.col(id_col), F.col(text_col).alias("_text")), store, schema, "_text", 1 << 18)
