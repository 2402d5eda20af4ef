"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file gives each token's bytes and rank.  The library wants merges of printable
characters, so bytes are mapped to characters, and the two parts of each token are found by
merging its bytes with the lower ranks only.  Every worker builds the encoder once.

The matches of the split pattern are encoded one by one in any case, so each batch hands only
its new matches to the library, all in one call, and keeps the ids of the units it has seen.
The library's fast call does not say which tokens belong to which match; the bytes of the tokens do.

Decoding looks up the bytes of each id and joins them before they are read as text, so a
character that is split over several tokens comes back whole.  Offsets (``offsets=True``) give, for
each token, where its bytes begin and end, and the characters it touches: tokens that share a
character each begin at or before it and end behind it.

Defined results
  null, empty text  no tokens
  ids               are passed through; null and repeated ids are rows like any other
  empty table       empty result
  extra columns     are ignored
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from vitrina.llm.pretokens import units
from vitrina.llm.text import texts

GROUP = 1 << 21  # bytes of text that are encoded at a time
REMEMBERED = 150_000  # units whose ids a worker keeps by default; beyond that it starts afresh


def byte_characters() -> list[str]:
    """A printable character for each byte: its own where it has one, else the next from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    table, spare = {byte: chr(byte) for byte in own}, 256
    for byte in range(256):
        if byte not in table:
            table[byte] = chr(spare)
            spare += 1
    return [table[byte] for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: merge its bytes in rank order, but not the last time."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:], strict=False)]
        i = min(range(len(pairs)), key=pairs.__getitem__)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class Codec:
    """Encoder of a rank file with the ids of the units seen so far, and the bytes of each id."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark decides on the number of cores
        ranks = read_ranks(path)
        characters = byte_characters()

        def shown(token: bytes) -> str:
            return "".join([characters[byte] for byte in token])

        ordered = sorted(ranks, key=ranks.__getitem__)
        merges = [tuple(map(shown, parts_of(token, ranks))) for token in ordered if len(token) > 1]
        self.encoder = Tokenizer(models.BPE({shown(token): rank for token, rank in ranks.items()}, merges))
        self.encoder.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Back through the table of characters, which is what the encoder's tokens are made of.
        byte_of = {character: byte for byte, character in enumerate(characters)}
        self.table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in self.encoder.get_vocab().items():
            self.table[rank] = bytes([byte_of[character] for character in token])
        self.lengths = np.array([len(token) for token in self.table], dtype=np.int32)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def unknown(self, seen: set[str]) -> list[str]:
        return [unit for unit in seen if unit not in self.known]

    def encoded(self, words: list[str]) -> dict[str, bytes]:
        """The ids of matches of the pattern; a token ends where its match does."""
        encoding = self.encoder.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(encoding.ids, dtype="<u4")
        sizes = np.fromiter((len(word.encode()) for word in words), np.int64, len(words))
        ends = np.searchsorted(np.cumsum(self.lengths[ids], dtype=np.int64), np.cumsum(sizes)) + 1
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return {word: raw[begin:end] for word, begin, end in zip(words, [0, *ends], ends, strict=False)}

    def learn(self, new: list[str]) -> None:
        """Encode each match of the pattern in the new units once."""
        # A match ends where a unit's last character meets the next unit's space, so such units are searched in one go.
        joint = [unit for unit in new if unit[0] == " " and not unit[-1].isspace()]
        unit_ends = np.cumsum(np.fromiter(map(len, joint), np.int64, len(joint)))
        matches = self.pattern.findall("".join(joint))
        match_ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        if len(joint) and (not len(matches) or match_ends[-1] != unit_ends[-1]):
            joint, matches = [], []  # a pattern that leaves out characters
        single = set(new).difference(joint)
        apart = {unit: self.pattern.findall(unit) for unit in single}
        ids = self.encoded(list(set(matches).union(*apart.values())))
        for unit, found in apart.items():
            self.known[unit] = b"".join([ids[word] for word in found])
        if not joint:
            return
        parts = [ids[word] for word in matches]
        raw = b"".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends = ends[np.searchsorted(match_ends, unit_ends)].tolist()
        self.known.update((unit, raw[begin:end]) for unit, begin, end in zip(joint, [0, *ends], ends, strict=False))

    def encode(self, group: Sequence[str], remembered: int = REMEMBERED) -> Iterator[np.ndarray]:
        """The ids of each text."""
        cut = list(map(units, group))
        seen = set().union(*cut)
        if len(self.known) > remembered:
            self.known = {}
        if new := self.unknown(seen):
            self.learn(new)
        for found in cut:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, found)), dtype="<u4")


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _groups(batch: pa.RecordBatch) -> Iterator[list[str]]:
    """The texts of a batch, a bounded number of bytes at a time."""
    group: list[str] = []
    size = 0
    for text in texts(batch, "text"):
        if group and size + len(text) > GROUP:
            yield group
            group, size = [], 0
        group.append(text.decode("utf-8"))
        size += len(text)
    if group:
        yield group


def decode(ids: Sequence[int], table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids])


def token_offsets(ids: np.ndarray, text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte behind, first character and character behind of each token of a text."""
    end = np.cumsum(lengths[ids])
    begin = end - lengths[ids]
    starts = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    before = np.append(0, np.cumsum(starts))  # characters that begin before a byte
    # A token that begins inside a character begins with that character.
    return begin, end, before[np.minimum(begin + 1, len(text))] - 1, before[end]


OFFSETS = ["byte_begins", "byte_ends", "char_begins", "char_ends"]


def bpe(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    offsets: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256 of every document, and with ``offsets`` those of ``OFFSETS``.

    ``remembered`` trades memory of a worker, some 200 bytes a unit, for time; it changes no result.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern)
        ints = pa.list_(pa.int32())
        for batch in batches:
            begin = 0
            for group in _groups(batch):
                rows = []
                for ids in known.encode(group, remembered):
                    back = decode(ids.tolist(), known.table)
                    spans = [part.astype(np.int32) for part in token_offsets(ids, back, known.lengths)] if offsets else []
                    digests = hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()
                    rows.append((ids.astype(np.int32), *digests, *spans))
                ids, encoded, decoded, *spans = zip(*rows, strict=True)
                columns = [pa.array(ids, ints), pa.array(encoded), pa.array(decoded), *(pa.array(s, ints) for s in spans)]
                names = ["doc_id", "ids", "ids_sha256", "decoded_sha256", *(OFFSETS if offsets else [])]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(begin, len(group)), *columns], names)
                begin += len(group)
        pa.default_memory_pool().release_unused()  # workers live on after their task

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"doc_id {kind}, ids array<int>, ids_sha256 string, decoded_sha256 string"
    schema += "".join(f", {name} array<int>" for name in OFFSETS) if offsets else ""
    found = chosen.mapInArrow(encode, schema)
    return found.withColumn("n_tokens", F.size("ids").cast("long"))
