"""Repeated passages across documents, by difference-cover anchors.

A difference cover of v holds residues so that any two positions have a common shift,
below v, that brings both onto covered residues. So if two documents share a window of
`window` words, wherever it stands in each, they share a run of `window - v + 1` words
that starts at a covered position in both. Only such runs, the anchors, are hashed and
sent around: 6 of 31 positions.

Where an anchor stands in two documents, the match is extended: all windows around it are
compared whole, by a 128-bit hash, and each window's smallest document id is found. A
window that its own document is not the smallest for is removed there. The extension never
forms pairs of documents: a passage in n documents costs n rows for each window. Each task
settles what it can among its own documents, so a passage that a third of all documents
hold sends at most two rows for each anchor and one for each window from each batch, however
often its documents repeat it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.shared import by_hot_key, written
from quirework.llm.words import (
    OTHER,
    PIECE,
    WORDS,
    groups_of_texts,
    hashed_words,
    mixed_bits,
    window_hashes,
)

#: Perfect difference sets: every residue is the difference of two members (fixed values).
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 6, 8, 18),
    31: (0, 1, 3, 8, 12, 18),
}
#: Rows without an id get one above this, by their text.
UNNUMBERED = 2**62


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    fitting = [v for v in COVERS if window - v + 1 >= max(1, window // 3)]
    return max(fitting, default=1)


class Cut:
    """The words of some texts, with what the passes need of them."""

    def __init__(self, texts: list[bytes], window: int):
        self.window, self.period = window, period_for(window)
        self.words, self.limits = hashed_words(texts)
        self.counts = np.diff(self.limits)
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        self.place = np.arange(len(self.words)) - self.limits[:-1][self.text]
        self.room = self.counts[self.text] - self.place

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Where they start among all words, and their hashes."""
        size = self.window - self.period + 1
        covered = np.zeros(self.period, bool)
        covered[list(COVERS.get(self.period, (0,)))] = True
        long = self.counts[self.text] >= self.window
        at = np.flatnonzero(long & covered[self.place % self.period] & (self.room >= size))
        return at, window_hashes(self.words, at, size)

    def around(self, at: np.ndarray) -> np.ndarray:
        """Whether each place starts a whole window that holds one of the anchors `at`."""
        steps = np.zeros(len(self.words) + 1, np.int64)
        before = np.maximum(at - (self.period - 1), self.limits[:-1][self.text[at]])
        np.add.at(steps, before, 1)
        np.add.at(steps, at + 1, -1)
        return (np.cumsum(steps)[:-1] > 0) & (self.room >= self.window)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values() if c is not None)
    found = {name: c if isinstance(c, pa.Array) else pa.array(c) for name, c in columns.items() if c is not None}
    arrays = [found[f.name].cast(f.type) if f.name in found else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# Anchors ------------------------------------------------------------------------------

ANCHORS = "k long, id long, hash long"
ANCHOR_SCHEMA = pa.schema([("k", pa.int64()), ("id", pa.int64()), ("hash", pa.int64())])
SHARED = "id long, hash long, sides int"
SHARED_SCHEMA = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("sides", pa.int32())])
#: An anchor's document has a smaller one with the same anchor, or a larger one.
LATER, EARLIER = 1, 2


def emit_anchors(window: int):
    """Each text's anchors as (hash, id).

    Of documents of a batch that share an anchor, only the smallest and the largest ask
    about the others; for those between, both answers are known. These go with a key of
    their own past the question, so that no key collects them.
    """

    def run(batches):
        for batch in batches:
            ids = batch["id"].to_numpy()
            for first, texts in groups_of_texts((t.as_buffer().to_pybytes() for t in batch["text"]), 4 * PIECE):
                cut = Cut(texts, window)
                at, hashes = cut.anchors()
                own = ids[first + cut.text[at]]
                order = np.lexsort((own, hashes))
                hashes, own = hashes[order], own[order]
                if not len(own):
                    continue
                new_hash = np.concatenate(([True], hashes[1:] != hashes[:-1]))
                new = new_hash | np.concatenate(([True], own[1:] != own[:-1]))
                hashes, own, new_hash = hashes[new], own[new], new_hash[new]
                between = ~new_hash & np.concatenate((~new_hash[1:], [False]))
                past = signed(mixed_bits(hashes[between] ^ mixed_bits(own[between].view(np.uint64), 5)))
                yield batch_of(ANCHOR_SCHEMA, k=signed(hashes[~between]), id=own[~between])
                yield batch_of(ANCHOR_SCHEMA, k=past, id=own[between], hash=signed(hashes[between]))

    return run


def shared_anchors(batches):
    """From rows sorted by key and id: the anchors that stand in other documents too."""
    open_key, open_id, later = None, None, False
    for batch in batches:
        known = np.asarray(batch["hash"].is_valid())
        key, own = batch["k"].to_numpy(), batch["id"].to_numpy()
        if known.any():
            past = batch["hash"].filter(pa.array(known))
            yield batch_of(
                SHARED_SCHEMA, id=own[known], hash=past, sides=np.full(len(past), LATER | EARLIER)
            )
            key, own = key[~known], own[~known]
        if open_key is not None:
            key, own = np.concatenate(([open_key], key)), np.concatenate(([open_id], own))
        if not len(key):
            continue
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])))
        key, own = key[new], own[new]
        follows = np.concatenate(([later and open_key is not None], key[1:] == key[:-1]))
        sides = follows * LATER + np.concatenate((follows[1:], [False])) * EARLIER
        told = sides[:-1] > 0
        yield batch_of(SHARED_SCHEMA, id=own[:-1][told], hash=key[:-1][told], sides=sides[:-1][told])
        open_key, open_id, later = key[-1], own[-1], bool(follows[-1])
    if open_key is not None and later:
        yield batch_of(SHARED_SCHEMA, id=[open_id], hash=[open_key], sides=[LATER])


# Windows ------------------------------------------------------------------------------

#: Stretches of words that are repeats, as numbers in turn: first place, size, first place, ...
WINDOWS = "h1 long, h2 long, id long, tag long, known boolean, stretches array<int>"
WINDOW_SCHEMA = pa.schema(
    [("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("known", pa.bool_()), ("stretches", pa.list_(pa.int32()))]
)
REPEATS = "id long, tag long, stretches array<int>"


def stretches(group: np.ndarray, place: np.ndarray, window: int, groups: int) -> pa.Array:
    """For each of `groups` groups, what windows at its places cover, as stretches that do not meet.

    `group` rises, and `place` in a group; a group may have no place.
    """
    new = np.ones(len(group), bool)
    new[1:] = (np.diff(group) > 0) | (np.diff(place) > window)
    begin = np.flatnonzero(new)
    last = np.concatenate((begin[1:], [len(group)]))[: len(begin)] - 1
    pairs = np.stack((place[begin], place[last] - place[begin] + window), axis=1).astype(np.int32)
    limits = 2 * np.searchsorted(group[begin], np.arange(groups + 1))
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(pairs.ravel()))


def emit_windows(window: int):
    """The windows around shared anchors: (hash, id, places), or repeats that are known already.

    Of the documents of a batch that share a window, only the smallest asks further, once for
    all places where it has the window: a text that repeats a line sends no row for each line.
    """

    def run(batches):
        for batch in batches:
            ids, tags = batch["id"].to_numpy(), batch["tag"].to_numpy()
            lists = batch["shared"]
            for first, texts in groups_of_texts((t.as_buffer().to_pybytes() for t in batch["text"]), 4 * PIECE):
                cut = Cut(texts, window)
                at, hashes = cut.anchors()
                part = lists.slice(first, len(texts))
                told = part.flatten()
                lengths = part.value_lengths().to_numpy()
                # A text's number is mixed into its hashes, so one sorted array serves all.
                salt = mixed_bits(np.arange(len(texts), dtype=np.uint64), 9)
                want = told.field("hash").to_numpy().view(np.uint64) ^ np.repeat(salt, lengths)
                order = np.argsort(want)
                want, sides = want[order], told.field("sides").to_numpy()[order]
                have = hashes ^ salt[cut.text[at]]
                spot = np.minimum(np.searchsorted(want, have), len(want) - 1)
                sides = np.where(want[spot] == have, sides[spot], 0)
                later = cut.around(at[sides & LATER > 0])
                places = np.flatnonzero(later | cut.around(at[sides & EARLIER > 0]))
                if not len(places):
                    continue
                h1 = window_hashes(cut.words, places, window, WORDS)
                h2 = window_hashes(cut.words, places, window, OTHER)
                row = first + cut.text[places]
                order = np.lexsort((places, row, ids[row], h2, h1))
                h1, h2, row, places = h1[order], h2[order], row[order], places[order]
                starts = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
                least = ids[row][np.maximum.accumulate(np.where(starts, np.arange(len(row)), 0))]
                repeat = ids[row] > least
                asks = np.flatnonzero(~repeat)
                new = starts[asks] | np.concatenate(([True], np.diff(row[asks]) != 0))
                group, wants = np.cumsum(new) - 1, later[places[asks]]
                heads = asks[new]
                yield batch_of(
                    WINDOW_SCHEMA, h1=signed(h1[heads]), h2=signed(h2[heads]), id=ids[row[heads]], tag=tags[row[heads]],
                    known=np.zeros(len(heads), bool),
                    stretches=stretches(group[wants], cut.place[places[asks[wants]]], window, len(heads)),
                )
                # A text's known repeats are one row.
                at = np.sort(places[repeat])
                if len(at):
                    new = np.concatenate(([True], np.diff(cut.text[at]) > 0))
                    heads = at[new]
                    row = first + cut.text[heads]
                    # Dealt out evenly: they only pass through.
                    spread = mixed_bits(mixed_bits(heads.astype(np.uint64), 1) ^ mixed_bits(ids[row].view(np.uint64), 2))
                    yield batch_of(
                        WINDOW_SCHEMA, h1=signed(spread), id=ids[row], tag=tags[row], known=np.ones(len(heads), bool),
                        stretches=stretches(np.cumsum(new) - 1, cut.place[at], window, len(heads)),
                    )

    return run


def repeated_windows(batches):
    """From rows sorted by hash and id: the stretches whose window a smaller document has."""
    h1_open = h2_open = least = None
    for batch in batches:
        known = np.asarray(batch["known"])
        yield batch.filter(pa.array(known)).select(["id", "tag", "stretches"])
        rows = batch.filter(pa.array(~known))
        h1, h2, own = (rows[c].to_numpy() for c in ("h1", "h2", "id"))
        if not len(h1):
            continue
        starts = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        smallest = own[np.maximum.accumulate(np.where(starts, np.arange(len(own)), 0))]
        if h1[0] == h1_open and h2[0] == h2_open:
            smallest[: np.argmax(starts[1:]) + 1 if starts[1:].any() else len(own)] = least
        h1_open, h2_open, least = h1[-1], h2[-1], smallest[-1]
        out = (own > smallest) & (rows["stretches"].value_lengths().to_numpy() > 0)
        yield rows.filter(pa.array(out)).select(["id", "tag", "stretches"])


# The operator -------------------------------------------------------------------------

RESULT = "id long, n_words long, n_removed long, kept binary"


def apply_repeats(window: int, with_text: bool):
    """Counts and the kept words (or the SHA-256 of them) of each text."""

    def run(batches):
        for batch in batches:
            out = {"id": batch["id"], "n_words": [], "n_removed": [], "kept": []}
            for text, tag, copy, repeats in zip(
                batch["text"], batch["tag"], batch["copy"], batch["repeats"], strict=True
            ):
                words = text.as_buffer().to_pybytes().split()
                removed = 0
                if copy.as_py() and len(words) >= window:
                    words, removed = [], len(words)
                elif repeats.is_valid:
                    rows = repeats.values
                    own = rows.field("stretches").filter(pa.array(rows.field("tag").to_numpy() == tag.as_py()))
                    place, size = own.flatten().to_numpy().reshape(-1, 2).T
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, place, 1)
                    np.add.at(steps, place + size, -1)
                    keep = np.cumsum(steps)[:-1] == 0
                    removed = len(words) - int(keep.sum())
                    words = [words[i] for i in np.flatnonzero(keep)]
                kept = b" ".join(words)
                out["n_words"].append(len(words) + removed)
                out["n_removed"].append(removed)
                out["kept"].append(kept if with_text else hashlib.sha256(kept).digest())
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
            )

    return run


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    with_text: bool = True,
) -> DataFrame:
    """Take out each word that lies in a window of words which a smaller document has too.

    `id`, `n_words`, `n_removed` and `kept`: the kept words joined by a space, in UTF-8
    (without `with_text`: the SHA-256 of that). One row for each input row. Windows are
    judged on the input. Rows that share an id are not repeats of each other. Rows without
    an id come after all others, in an order of their texts' hashes; their id stays null.
    An id of 2**62 or more is an error. A null text has no words. Of texts that are the same
    as a whole, those after the first are settled by a digest of the text and take no further
    part.

    The text is shuffled once, by id; the three passes that need it read that shuffle. Texts'
    digests are written before, a narrow table.
    """
    tag = F.xxhash64("text")
    number = F.col(id_col).cast("long")
    too_large = F.raise_error(F.lit(f"without_repeats: ids of {UNNUMBERED} and above are not supported")).cast("long")
    base = docs.select(
        F.coalesce(
            F.when(number >= UNNUMBERED, too_large).otherwise(number),
            F.lit(UNNUMBERED) + F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 3),
        ).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).select("id", tag.alias("tag"), F.col("text").cast("binary").alias("text"))
    digests = written(base.select("id", "tag", F.unhex(F.sha2("text", 256)).alias("digest")), "digests")
    firsts = written(
        digests.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts"
    )
    # Large groups of copies get their first by a broadcast of the few of them.
    copies = (
        by_hot_key(digests, firsts, "digest").where("id > first").groupBy("id").agg(F.collect_set("tag").alias("copies"))
    )
    is_copy = F.coalesce(F.array_contains("copies", F.col("tag")), F.lit(False))
    marked = base.join(copies, "id", "left").select("id", "tag", "text", is_copy.alias("copy"))
    shared = (
        marked.where(~F.col("copy"))
        .select("id", "text")
        .mapInArrow(emit_anchors(window), ANCHORS)
        .repartition("k")
        .sortWithinPartitions("k", "id")
        .mapInArrow(shared_anchors, SHARED)
        .groupBy("id")
        .agg(F.collect_list(F.struct("hash", "sides")).alias("shared"))
    )
    repeats = (
        base.join(shared, "id")
        .select("id", "tag", "text", "shared")
        .mapInArrow(emit_windows(window), WINDOWS)
        .repartition("h1")
        .sortWithinPartitions("h1", "h2", "id")
        .mapInArrow(repeated_windows, REPEATS)
        .groupBy("id")
        .agg(F.collect_list(F.struct("tag", "stretches")).alias("repeats"))
    )
    applied = (
        marked.join(repeats, "id", "left")
        .select("id", "tag", "text", "copy", "repeats")
        .mapInArrow(apply_repeats(window, with_text), RESULT)
    )
    return applied.withColumn("id", F.when(F.col("id") < UNNUMBERED, F.col("id")))
