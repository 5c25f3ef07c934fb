"""Token-ID output: raw id payloads in shards, with a minimal perfect hash index for each.

A shard is two files. `.ids` holds the token ids of its documents, one after the other, as
little-endian unsigned integers (16 bits if the vocabulary allows, else 32) and nothing
else. `.mph` holds the index: a key leads in constant time to a slot, which has a
fingerprint of the key, the offset of the document's ids and their number. Keys are not
stored; a key that is not in the shard is told by its fingerprint (wrong once in 2**32).

Documents are in ascending order of their id over all shards. Each task encodes its range
of ids and writes its shards as it goes, so a task holds a batch of texts and one shard's
index. A shard's ids are closed at `shard_bytes`.
"""

from __future__ import annotations

import bisect
import io
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import NewFile, located, new_folder, read_bytes, written
from quirework.llm.words import mixed_bits

MANIFEST = (
    "part long, seq long, n_docs long, n_tokens long, width long, ids_uri string, mph_uri string"
)

# Encoding -----------------------------------------------------------------------------

#: A space before something else than white space: the text can be cut in front of it.
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Latin letters, then at most some plain signs: its pieces are known without a search.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?*$#%&|]+)?")
#: A line end between two pieces is a piece of its own; a plain word after it has no blank.
_LINE_END = re.compile(rf"(\S+)\n{_PLAIN.pattern}")
RUNS = 10_000


class NoCut(Exception):
    """A space stands before white space or at the end: the text can't be cut there."""


class Words(dict):
    """Ids of pieces; one that is not here is worked out by `known`."""

    def __init__(self, known):
        super().__init__()
        self.known = known

    def __missing__(self, text: str) -> bytes:
        return self.known(text)


class WordEncoder:
    """Ids of whole texts from a byte-level BPE file, remembering words.

    The library's pre-tokenizer never joins characters over a space that is followed by
    something else than white space. So a text is cut there, and each piece has the same
    ids wherever it stands. The pieces of the last `memory` to twice as many different ones
    are kept. New ones go through the library's own pre-tokenizer and model. Strings of
    added tokens in a text are ordinary text, or, with `added`, get their own ids: a text
    that holds one is encoded by the library as a whole.
    """

    def __init__(self, path: str, memory: int = 300_000, added: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        whole = Tokenizer.from_file(path)
        if whole.normalizer is not None or not isinstance(whole.pre_tokenizer, ByteLevel):
            raise ValueError("the tokenizer must be byte-level, without a normalizer")
        if whole.pre_tokenizer.add_prefix_space or not whole.pre_tokenizer.use_regex:
            raise ValueError("the tokenizer must split by its pattern, without a prefix space")
        names = [t.content for t in whole.get_added_tokens_decoder().values()] if added else []
        self.whole, self.named = whole, re.compile("|".join(map(re.escape, names))).search if names else None
        self.model, self.split = whole.model, whole.pre_tokenizer.pre_tokenize_str
        self.type = np.dtype("<u2" if whole.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        size = self.type.itemsize
        self.tokenize = self.model.tokenize
        self.codes = [n.to_bytes(size, "little") for n in range(whole.get_vocab_size(with_added_tokens=True))]
        self.memory, self.after, self.before, self.runs = memory, Words(self.known), {}, {}
        # The characters by which the model writes the bytes of blanks and of Latin letters.
        self.blank, self.line_end = self.split(" ")[0][0], self.split("\n")[0][0]
        self.signs = {n: self.split(chr(n))[0][0] for n in range(0xC0, 0x250)}

    def bytes_of(self, pieces: list[str]) -> bytes:
        codes = self.codes
        return b"".join([codes[t.id] for p in pieces for t in self.tokenize(p)])

    def run(self, signs: str) -> bytes:
        """Ids of plain signs, of which few different runs are common; up to `RUNS` are kept."""
        if (ids := self.runs.get(signs)) is None:
            ids = self.bytes_of([signs])
            if len(self.runs) < RUNS:
                self.runs[signs] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of a blank and what follows it."""
        if text.isascii() and text.isalpha():
            codes = self.codes
            return b"".join([codes[t.id] for t in self.tokenize(self.blank + text)])
        if not text or text[0].isspace():
            raise NoCut
        if plain := _PLAIN.fullmatch(text):
            word, signs = plain.groups()
            if signs:
                return self.known(word) + self.run(signs)
            return self.bytes_of([self.blank + word.translate(self.signs)])
        if line := _LINE_END.fullmatch(text):
            left, word, signs = line.groups()
            right = self.bytes_of([self.line_end, word.translate(self.signs)])
            return self.known(left) + right + (self.run(signs) if signs else b"")
        return self.bytes_of([p for p, _ in self.split(f" {text}")])

    def known(self, text: str) -> bytes:
        """As `piece`, remembered: in two halves, of which the older one is dropped in turn."""
        if (ids := self.after.get(text)) is None:
            if (ids := self.before.get(text)) is None:
                ids = self.piece(text)
            if len(text) < 64:
                if len(self.after) >= self.memory:
                    self.after, self.before = Words(self.known), self.after
                self.after[text] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.named and self.named(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.type).tobytes()
        first, *rest = text.split(" ")
        try:
            found = b"".join(map(self.after.__getitem__, rest))
        except NoCut:
            first, *rest = _SAFE_CUT.split(text)
            found = b"".join([self.after[p[1:]] for p in rest])
        return self.bytes_of([p for p, _ in self.split(first)]) + found


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, added: bool = False) -> WordEncoder:
    """One for each Python worker."""
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = WordEncoder(path, added=added)
    return _ENCODERS[path, added]


# The index ----------------------------------------------------------------------------


def key_bits(hashes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Of a key's hash and its number among equal keys."""
    return mixed_bits(hashes.astype(np.int64).view(np.uint64), 1) ^ mixed_bits(
        repeats.astype(np.uint64), 2
    )


class PerfectHash:
    """Different 64-bit numbers to 0..n-1, each once, in levels of bits.

    Each level has `spread` bits for each key that is left. A key that alone hashes to its
    bit stays there; the others go on. A key's slot is the number of set bits before its
    own. Keys that share all 64 bits never part: after 60 levels the rest is listed, which
    makes an equal pair an error of the caller.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 1.5) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            if len(sizes) == 60:
                raise ValueError("two keys have the same 64-bit hash")
            size = -(-int(len(keys) * spread + 8) // 8) * 8
            at = (mixed_bits(keys, 10 + len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit; a strange key may also get a slot."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes, self.starts, strict=False)):
            at = start + (mixed_bits(keys[left], 10 + level) % np.uint64(size)).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            here = (self.bits[byte] >> bit) & 1 == 1
            below = self.bits[byte] & ((np.uint8(1) << bit) - np.uint8(1)).astype(np.uint8)
            rank = self.ranks[byte] + np.bitwise_count(below)
            found[left[here]] = rank[here]
            left = left[~here]
        return found


def index_bytes(keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> bytes:
    hashed = PerfectHash.build(keys)
    slots = hashed.slots(keys)
    arrays = {"sizes": hashed.sizes, "bits": hashed.bits}
    for name, values in (
        ("prints", (mixed_bits(keys, 3) >> np.uint64(32)).astype(np.uint32)),
        ("offsets", offsets.astype(np.uint64)),
        ("counts", counts.astype(np.uint64)),
    ):
        arrays[name] = np.empty_like(values)
        arrays[name][slots] = values
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


class Shard:
    """Keyed access to one shard's ids."""

    def __init__(self, ids_uri: str, mph_uri: str, width: int):
        self.table = dict(np.load(io.BytesIO(read_bytes(mph_uri))))
        self.hashed = PerfectHash(self.table["sizes"], self.table["bits"])
        files, path = located(ids_uri)
        self.file, self.type = files.open_input_file(path), np.dtype(f"<u{width}")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and number of ids for each key; -1 and 0 for keys that are not here."""
        slots = self.hashed.slots(keys)
        prints = (mixed_bits(keys, 3) >> np.uint64(32)).astype(np.uint32)
        here = slots >= 0
        here[here] = self.table["prints"][slots[here]] == prints[here]
        offsets = np.where(here, self.table["offsets"][slots].astype(np.int64) if len(slots) else 0, -1)
        return offsets, np.where(here, self.table["counts"][slots].astype(np.int64) if len(slots) else 0, 0)

    def ids(self, offset: int, count: int) -> np.ndarray:
        self.file.seek(offset * self.type.itemsize)
        return np.frombuffer(self.file.read(count * self.type.itemsize), self.type).astype("<u4")


def numbered(ids: list, last) -> tuple[np.ndarray, tuple]:
    """The number of each id among the equal ones in front of it, over sorted batches."""
    out, (before, n) = np.zeros(len(ids), np.int64), last
    for i, x in enumerate(ids):
        n = n + 1 if (x,) == before else 0
        out[i], before = n, (x,)
    return out, (before, n)


# Operators ----------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 2,
    shard_bytes: int = 256 << 20,
    folder: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """Write all documents' ids and indexes; returns the manifest, a written table.

    A null text has no ids but the end. Equal ids, null ones too (they come first), are
    told apart by their number in order of their texts. An empty table gives no shards.
    With `added_tokens`, strings of added tokens get their ids, as in the library's plain
    call; else they are ordinary text.
    """
    folder = folder or new_folder(docs.sparkSession, "tokens")

    def write(batches):
        encode, end = encoder(tokenizer_path, added_tokens), b""
        if end_id is not None:
            end = np.array([end_id], encode.type).tobytes()
        part, seq, last = TaskContext.get().partitionId(), 0, (None, 0)
        out, keys, counts, total, first = None, [], [], 0, None

        def close():
            nonlocal out, keys, counts, total, seq
            out.__exit__(None, None, None)
            n = np.array(counts, np.int64)
            with NewFile(f"{folder}/shards", f"shard-{part:05d}-{seq:04d}", ".mph") as index:
                index.write(index_bytes(np.array(keys, np.uint64), np.cumsum(n) - n, n))
            row = [part, seq, len(n), int(n.sum()), encode.type.itemsize, out.uri, index.uri]
            out, keys, counts, total, seq = None, [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(
                {f.split()[0]: [x] for f, x in zip(MANIFEST.split(", "), row, strict=True)}
                | {"first_id": first}
            )

        for batch in batches:
            repeats, last = numbered(batch["id"].to_pylist(), last)
            if not len(repeats):
                continue
            key = key_bits(batch["hash"].to_numpy(), repeats)
            for at, (bits, text) in enumerate(zip(key, batch["text"], strict=True)):
                if out is None:
                    first = batch["id"].slice(at, 1)
                    out = NewFile(f"{folder}/shards", f"shard-{part:05d}-{seq:04d}", ".ids").__enter__()
                ids = encode(text.as_py()) + end
                out.write(ids)
                keys.append(bits)
                counts.append(len(ids) // encode.type.itemsize)
                total += len(ids)
                if total >= shard_bytes:
                    yield close()
        if out is not None:
            yield close()

    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("hash"), F.col(text_col).alias("text")
    )
    sorted_rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    return written(sorted_rows.mapInArrow(write, f"{MANIFEST}, first_id {kind}"), "manifest")


def read_tokens(manifest: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Look each key up in the shards: `id`, `repeat`, `start`, `n_tokens`, `ids`.

    `start` counts the ids of all documents before it; `ids` are 32-bit little-endian. Of
    a key that stands k times in `keys`, the first k of its documents come. Keys that are
    in no shard give nulls. The keys are sorted like the shards, so each task opens
    few, found by their first ids. The manifest, a row for each shard of 256 MB, goes to
    all tasks (at most 1,000,000 rows: 256 TB of ids).
    """
    rows = manifest.orderBy("part", "seq").limit(1_000_001).collect()
    if len(rows) > 1_000_000:
        raise ValueError("over 1,000,000 shards: write larger ones")
    bases = np.concatenate(([0], np.cumsum([r.n_tokens for r in rows], dtype=np.int64))).tolist()
    shards = [(r.ids_uri, r.mph_uri, r.width) for r in rows]
    firsts = [(r.first_id is not None, r.first_id) for r in rows]

    def read(batches):
        at, shard, last = -1, None, (None, 0)

        def opened(i):
            nonlocal at, shard
            if i != at:
                at, shard = i, Shard(*shards[i])
            return shard

        def found(places, key):
            """(base, offset, count) of each key, shard by shard."""
            out = [(None, None, None)] * len(key)
            while places:
                later = {}
                for i, rows in places.items():
                    o, n = opened(i).find(key[rows])
                    for row, offset, count in zip(rows, o.tolist(), n.tolist(), strict=True):
                        if offset >= 0:
                            out[row] = (i, offset, count)
                        # The first of equal ids may end the shard before.
                        elif i and firsts[i] == ranks[row]:
                            later.setdefault(i - 1, []).append(row)
                places = later
            return out

        for batch in batches:
            ids = batch["id"].to_pylist()
            repeats, last = numbered(ids, last)
            key = key_bits(batch["hash"].to_numpy(), repeats) if ids else np.zeros(0, np.uint64)
            ranks = [(x is not None, x) for x in ids]
            for begin in range(0, len(key), 500):
                places: dict[int, list[int]] = {}
                for row in range(begin, min(begin + 500, len(key))):
                    if (i := bisect.bisect_right(firsts, ranks[row]) - 1) >= 0:
                        places.setdefault(i, []).append(row)
                hits = found(places, key)[begin : begin + 500]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch["id"].slice(begin, len(hits)),
                        "repeat": pa.array(repeats[begin : begin + 500], pa.int64()),
                        "start": pa.array([i if i is None else bases[i] + o for i, o, _ in hits], pa.int64()),
                        "n_tokens": pa.array([n for _, _, n in hits], pa.int64()),
                        "ids": pa.array(
                            [i if i is None else opened(i).ids(o, n).tobytes() for i, o, n in hits],
                            pa.binary(),
                        ),
                    }
                )

    kind = keys.schema[id_col].dataType.simpleString()
    sorted_keys = (
        keys.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("hash"))
        .repartitionByRange("id")
        .sortWithinPartitions("id")
    )
    return sorted_keys.mapInArrow(
        read, f"id {kind}, repeat long, start long, n_tokens long, ids binary"
    )
