"""Token counts from a tokenizer compiled into deterministic transducers.

Byte-level BPE has a last token for every prefix of a word: the one token t for which the
prefix before t, followed by t, is what BPE gives.  So the number of tokens of a prefix is one
more than that of the prefix before its last token, and what follows depends only on the
starts that some vocabulary entry can still be read from.  A state is the list of those
starts: the node reached in the trie of the vocabulary, the last token before the start, and
the tokens counted since.  Equal lists are one state, which makes the automaton finite and
deterministic.  A transition reads a byte and is annotated with the change in the number of
emitted tokens.  States and transitions are compiled when a text first needs them and kept in
a bounded table.

Whole words are compiled a second time: a unit of text that the split pattern cannot cross
becomes one transition of the upper transducer, annotated with its total.

Long texts are read in chunks.  The map of a chunk takes any state at its beginning to the
state at its end.  A point where a character that is no white space meets one that is resets
the transducer, so a chunk's map is described by the part before its first such point, the
count up to its last one, and the part after it.  Maps compose associatively; a prefix scan in
pairs gives the map, and so the count, of the whole text.

Strings of special tokens inside a text are one token each, as the library has it by default.

Defined results
  null, empty text  0 bytes, 0 tokens
  ids               are passed through; null and repeated ids are rows like any other
  empty table       empty result
  extra columns     are ignored
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.bpe import byte_characters
from vitrina.llm.pretokens import units
from vitrina.llm.text import texts

LIMIT = 1024
CHUNK = 1 << 20  # characters of a text that are read at a time
TRANSITIONS = 2_000_000  # compiled transitions a worker keeps
REMEMBERED = 1_000_000  # units a worker keeps

# Fixed value: the split pattern of byte-level tokenizer files, which name it only by its kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# Between a character that is no white space and one that is: no match reaches across.
RESET, LAST_RESET = regex.compile(r"(?<=\S)(?=\s)"), regex.compile(r"(?r)(?<=\S)(?=\s)")


class WordTransducer:
    """Counts the tokens of one match of the split pattern, byte by byte."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        byte_of = {character: byte for byte, character in enumerate(byte_characters())}
        self.bytes_of = {i: bytes([byte_of[c] for c in token]) for token, i in vocabulary.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.pair_rank[left, right] = rank
            self.split.setdefault(whole, (left, right, rank))
        # The trie: one node per prefix of an entry, (node << 8 | byte) -> next node.
        self.next: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [True]
        for i, spelled in self.bytes_of.items():
            node = 0
            for byte in spelled:
                self.inner[node] = True
                at = node << 8 | byte
                if at not in self.next:
                    self.next[at] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.next[at]
            self.token[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.step: dict[int, tuple[int, int]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the border between two neighbouring tokens.

        The two tokens are taken apart again, the later merge first.  The border falls if a
        merge across it ranks before the merges that hide its two sides.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, limit = left, right, len(self.pair_rank)
        fits = True
        while True:
            across = self.pair_rank.get((a, b))
            if across is not None and across < limit:
                fits = False
                break
            parts_a, parts_b = self.split.get(a), self.split.get(b)
            rank_a = parts_a[2] if parts_a else -1
            rank_b = parts_b[2] if parts_b else -1
            if rank_a < 0 and rank_b < 0:
                break
            # Of two equal merges the left one comes first, so the right one is undone first.
            if rank_a > rank_b:
                a, limit = parts_a[1], rank_a
            else:
                b, limit = parts_b[0], rank_b + 1
        self.fits[left, right] = fits
        return fits

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state under a byte: (next state, change of the count)."""
        moved = []
        last, count = -1, 0
        for node, before, since in self.states[state]:
            node = self.next.get(node << 8 | byte)
            if node is None:
                continue
            moved.append((node, before, since))
            token = self.token[node]
            if token >= 0 and last < 0 and (before < 0 or self.compatible(before, token)):
                last, count = token, since + 1
        # Counts are kept relative to the new end of the word.
        left = [(node, before, since - count) for node, before, since in moved if self.inner[node]]
        reached = (*left, (0, last, 0))
        number = self.number.setdefault(reached, len(self.states))
        if number == len(self.states):
            self.states.append(reached)
        self.step[state << 8 | byte] = found = number, count
        return found

    def count(self, word: bytes) -> int:
        if len(self.step) > TRANSITIONS:
            self.clear()
        state, total, step = 0, 0, self.step
        for byte in word:
            state, emitted = step.get(state << 8 | byte) or self.compile(state, byte)
            total += emitted
        return total


class Summary(NamedTuple):
    """The map of a chunk: what comes before its first reset, the count between, what is left."""

    head: str
    count: int
    tail: str | None  # None: the chunk has no reset, all of it is head


class TokenCounter:
    """The transducers of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE without a normalizer")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.words = WordTransducer(spec["model"]["vocab"], merges)
        self.marks = [token["content"] for token in spec["added_tokens"]]
        if any(len(mark.split()) != 1 for mark in self.marks):
            raise ValueError("special tokens with white space are not supported")
        self.special = regex.compile("|".join(map(regex.escape, self.marks))) if self.marks else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def unit(self, unit: str) -> int:
        """Tokens of a unit, or of any text that is read from a reset to a reset."""
        if self.special and any(mark in unit for mark in self.marks):
            parts = self.special.split(unit)
            return len(parts) - 1 + sum(map(self._plain, filter(None, parts)))
        return self._plain(unit)

    def _plain(self, text: str) -> int:
        count = self.words.count
        return sum([count(word.encode("utf-8")) for word in self.pattern.findall(text)])

    def _units(self, text: str) -> list[str]:
        found = units(text)
        known = self.known
        for unit in [unit for unit in set(found) if unit not in known]:
            known[unit] = self.unit(unit)
        return found

    def total(self, text: str) -> int:
        if len(self.known) > REMEMBERED:
            self.known = {}
        return sum(map(self.known.__getitem__, self._units(text))) if text else 0

    def summary(self, chunk: str) -> Summary:
        """The map of a chunk of a longer text."""
        first = RESET.search(chunk)
        if first is None:
            return Summary(chunk, 0, None)
        begin, end = first.start(), LAST_RESET.search(chunk).start()
        return Summary(chunk[:begin], self.total(chunk[begin:end]), chunk[end:])

    def compose(self, a: Summary, b: Summary) -> Summary:
        """The map of two chunks in a row; associative.

        The open end of ``a`` and the open beginning of ``b`` meet; the point between them may be a reset too.
        """
        joined = (a.head if a.tail is None else a.tail) + b.head
        if a.tail is not None and b.tail is not None:
            return Summary(a.head, a.count + self.total(joined) + b.count, b.tail)
        middle = self.summary(joined)
        if a.tail is None and b.tail is None:
            return middle
        if a.tail is None:
            inner = 0 if middle.tail is None else middle.count + self.total(middle.tail)
            return Summary(middle.head, inner + b.count, b.tail)
        if middle.tail is None:
            return Summary(a.head, a.count, middle.head)
        return Summary(a.head, a.count + self.total(middle.head) + middle.count, middle.tail)

    def scan(self, maps: list[Summary]) -> Summary:
        """All maps composed, in pairs of pairs."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[2 * len(pairs) :]
        return maps[0]

    def count(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.total(text)
        whole = self.scan([self.summary(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])
        return self.total(whole.head) + whole.count + self.total(whole.tail or "")


@functools.lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = counter(path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in texts(batch, "text"):
                n_bytes.append(len(text))
                n_tokens.append(compiled.count(text.decode("utf-8")))
            columns = [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = chosen.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
