"""Groups of equal texts, and the row of each that stays, from a cuckoo-filter index.

Two texts are equal when they are identical after deleting white space of ASCII (blank, tab,
line, page and carriage ends). Of equal texts the row with the most characters stays, then
the one with the smallest id; of rows repeated in whole one stays.

Method: a cuckoo filter of live digests. A digest (sha256 of the stripped text) belongs to two
buckets of four slots, which follow from its bits and from its 16-bit print. A look-up
compares prints in both buckets; each hit is verified against the bucket's content, the
whole digest, before it counts. A new digest takes a free slot or pushes an older one to
its other bucket; where that chain grows too long the index overflows and is rebuilt with
twice the buckets from the digests it stores. Deleting a text lowers its count; at zero its
slot is free again.

On Spark: digests and lengths are taken in the JVM, so no text is shuffled or sent to
Python. Each task first folds its own rows in an index of bounded size, so a text held by a third of
all rows leaves a task as one row. What is left is dealt to shards by digest bits, of at
most about `SHARD_ROWS` rows each, and a shard's index is built by one task. `insert` and
`delete` bring new and gone documents to the shards of a stored index; an index is a table
with one row for each live digest, its bucket and slot included, so it is taken up as it
was left. Groups go back to their rows by digest: those with more than one row in `HOT_SHARE`,
of which there are at most `HOT_SHARE`, by broadcast, all others by a shuffle.

Edge cases: a null text counts as empty, and all empty texts are equal; a null id comes
after all others; repeated rows are rows like others; ids are whole numbers; an empty table
gives no rows. Only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import mix
from tidemark.sources.files import store

#: fixed values: the characters that do not count
WHITE_SPACE = " \t\n\x0b\x0c\r"

SLOTS = 4
MAX_KICKS = 200
FIRST_BUCKETS = 256
PRINT_BITS = 16

FOLD_ROWS = 100_000
SHARD_ROWS = 250_000
HOT_SHARE = 10_000

ENTRY = "digest binary, n long, chars long, id long, row long"
INDEX = f"shard long, buckets long, slot long, {ENTRY}"

_FIELDS = ("n", "chars", "id", "row")
_NO_ID = np.iinfo(np.int64).max  # sorts after all others


class CuckooIndex:
    """Live digests with their counts and the row that stays.

    `words` are digests as rows of four 64-bit numbers. The first is left to the shards, the
    second gives the print, the third the bucket.
    """

    def __init__(self, buckets: int = FIRST_BUCKETS, print_bits: int = PRINT_BITS):
        self.print_bits = print_bits
        self.words = np.zeros((0, 4), np.uint64)
        self.held = {f: np.zeros(0, np.int64) for f in _FIELDS}
        self.free: list[int] = []  # entries whose digest was deleted
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.prints = np.zeros(buckets * SLOTS, np.uint32)
        self.entry = np.full(buckets * SLOTS, -1, np.int64)

    def __len__(self) -> int:
        return len(self.words) - len(self.free)

    # --- places -----------------------------------------------------------------

    def _print(self, words: np.ndarray) -> np.ndarray:
        """Never 0, which marks a free slot."""
        return (words[:, 1] & np.uint64((1 << self.print_bits) - 1)).astype(np.uint32) + np.uint32(1)

    def _bucket(self, words: np.ndarray) -> np.ndarray:
        return (words[:, 2] & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """The other of the two buckets, told from the print alone."""
        return bucket ^ (mix(print_) & np.uint64(self.buckets - 1)).astype(np.int64)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot and entry of each digest, -1 where it is not live."""
        print_, one = self._print(words), self._bucket(words)
        slot = np.full(len(words), -1, np.int64)
        for bucket in (one, self._other(one, print_)):
            for i in range(SLOTS):
                at = bucket * SLOTS + i
                hit = np.flatnonzero((self.prints[at] == print_) & (slot < 0))
                same = (self.words[self.entry[at[hit]]] == words[hit]).all(1)  # the bucket's content decides
                slot[hit[same]] = at[hit[same]]
        return slot, np.where(slot >= 0, self.entry[slot], -1)

    # --- insertion --------------------------------------------------------------

    def insert(self, words: np.ndarray, rows: dict[str, np.ndarray]) -> None:
        """Add rows: `n` rows of a digest, and the best of them by chars, id and row."""
        todo = np.arange(len(words))
        while len(todo):
            _, entry = self.find(words[todo])
            known = entry >= 0
            if known.any():
                self._merge(entry[known], {f: rows[f][todo[known]] for f in _FIELDS})
            todo = todo[~known]
            # equal digests share a bucket, so of them only the first is new
            _, first = np.unique(self._bucket(words[todo]), return_index=True)
            new = todo[np.sort(first)]
            self._place(self._store(words[new], {f: rows[f][new] for f in _FIELDS}))
            todo = np.setdiff1d(todo, new, assume_unique=True)

    def _store(self, words: np.ndarray, rows: dict[str, np.ndarray]) -> np.ndarray:
        """Entries that hold the new digests, those of deleted ones first."""
        again = np.array([self.free.pop() for _ in range(min(len(self.free), len(words)))], np.int64)
        at = np.append(again, len(self.words) + np.arange(len(words) - len(again)))
        more = len(words) - len(again)
        self.words = np.concatenate([self.words, np.zeros((more, 4), np.uint64)])
        self.words[at] = words
        for f in _FIELDS:
            self.held[f] = np.append(self.held[f], np.zeros(more, np.int64))
            self.held[f][at] = rows[f]
        return at

    def _place(self, entries: np.ndarray) -> None:
        """Give entries a slot; those of one call have different first buckets or come again."""
        while len(entries):
            words = self.words[entries]
            print_, one = self._print(words), self._bucket(words)
            placed = np.zeros(len(entries), bool)
            for bucket in (one, self._other(one, print_)):
                _, first = np.unique(bucket, return_index=True)
                turn = np.zeros(len(entries), bool)
                turn[first] = True
                free = self.prints.reshape(-1, SLOTS)[bucket] == 0
                ready = np.flatnonzero(turn & ~placed & free.any(1))
                slot = bucket[ready] * SLOTS + free[ready].argmax(1)
                self.prints[slot], self.entry[slot] = print_[ready], entries[ready]
                placed[ready] = True
            entries = entries[~placed]
            if not placed.any():
                for entry in entries.tolist():
                    if not self._push(entry):
                        self._grow()  # takes up every entry, these included
                        return
                return

    def _push(self, entry: int) -> bool:
        """Place one entry by moving others on; False when the chain grows too long."""
        words = self.words[entry : entry + 1]
        print_, bucket = int(self._print(words)[0]), int(self._bucket(words)[0])
        for kick in range(MAX_KICKS):
            base = bucket * SLOTS
            held = self.prints[base : base + SLOTS].tolist()
            full = 0 not in held
            slot = base + (kick % SLOTS if full else held.index(0))
            moved = int(self.entry[slot]), int(self.prints[slot])
            self.prints[slot], self.entry[slot] = print_, entry
            if not full:
                return True
            entry, print_ = moved
            bucket = int(self._other(np.array([bucket]), np.array([print_]))[0])
        return False

    def _grow(self) -> None:
        """Twice the buckets, filled anew from the stored digests."""
        self.resizes += 1
        self._clear(self.buckets * 2)
        live = np.ones(len(self.words), bool)
        live[self.free] = False
        left = np.flatnonzero(live)
        while len(left):
            _, first = np.unique(self._bucket(self.words[left]), return_index=True)
            turn = left[np.sort(first)]
            size = self.buckets
            self._place(turn)
            if self.buckets != size:  # grew again within, and took up all
                return
            left = np.setdiff1d(left, turn, assume_unique=True)

    def _merge(self, entry: np.ndarray, rows: dict[str, np.ndarray]) -> None:
        """Counts add up; the best row stays."""
        np.add.at(self.held["n"], entry, rows["n"])
        order = np.lexsort((rows["row"], rows["id"], -rows["chars"], entry))
        entry, first = np.unique(entry[order], return_index=True)
        best = order[first]
        one, two = {f: self.held[f][entry] for f in _FIELDS}, {f: rows[f][best] for f in _FIELDS}
        longer, equal = two["chars"] > one["chars"], two["chars"] == one["chars"]
        before = (two["id"] < one["id"]) | ((two["id"] == one["id"]) & (two["row"] < one["row"]))
        better = longer | (equal & before)
        for f in ("chars", "id", "row"):
            self.held[f][entry[better]] = two[f][better]

    # --- deletion ---------------------------------------------------------------

    def delete(self, words: np.ndarray, rows: dict[str, np.ndarray]) -> None:
        """Take rows away. A digest without rows leaves; where the row that stays is gone
        and others are left, `chars` is -1 until `insert` brings them with n = 0. Digests
        that are not live are left alone. Each digest is given once."""
        slot, entry = self.find(words)
        known = np.flatnonzero(entry >= 0)
        slot, entry = slot[known], entry[known]
        self.held["n"][entry] -= rows["n"][known]
        gone = self.held["n"][entry] <= 0
        self.prints[slot[gone]], self.entry[slot[gone]] = 0, -1
        self.free += entry[gone].tolist()
        lost = (rows["chars"][known] == self.held["chars"][entry]) & (rows["id"][known] == self.held["id"][entry])
        orphan = entry[lost & ~gone]
        for f, value in (("chars", -1), ("id", _NO_ID), ("row", _NO_ID)):
            self.held[f][orphan] = value

    # --- as rows ----------------------------------------------------------------

    def to_table(self) -> pa.Table:
        """One row for each live digest, with its slot."""
        slot = np.flatnonzero(self.prints)
        entry = self.entry[slot]
        return pa.table(
            {
                "buckets": np.full(len(slot), self.buckets),
                "slot": slot,
                **_entry_columns(self.words[entry], {f: self.held[f][entry] for f in _FIELDS}),
            }
        )

    @classmethod
    def from_table(cls, table: pa.Table, print_bits: int = PRINT_BITS) -> CuckooIndex:
        """The index as it was left: no digest is placed anew."""
        if not len(table):
            return cls(print_bits=print_bits)
        index = cls(int(table.column("buckets")[0].as_py()), print_bits)
        index.words, index.held = entries_of(table)
        slot = table.column("slot").to_numpy()
        index.prints[slot] = index._print(index.words)
        index.entry[slot] = np.arange(len(table))
        return index


def entries_of(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Digests as four numbers each, and the other columns of ENTRY, from a table or batch."""
    digest = table.column("digest")
    if isinstance(digest, pa.ChunkedArray):
        digest = digest.combine_chunks()
    if not len(table):
        return np.zeros((0, 4), np.uint64), {f: np.zeros(0, np.int64) for f in _FIELDS}
    words = np.frombuffer(b"".join(digest.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 4)
    held = {f: table.column(f).fill_null(_NO_ID).to_numpy().astype(np.int64) for f in _FIELDS}
    return words, held


def _entry_columns(words: np.ndarray, rows: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    packed = words.astype(">u8").tobytes()
    digests = [packed[i : i + 32] for i in range(0, len(packed), 32)]
    columns = {f: pa.array(rows[f], mask=(rows[f] == _NO_ID) if f in ("id", "row") else None) for f in _FIELDS}
    return {"digest": pa.array(digests, pa.binary()), **columns}


# --- on tables ------------------------------------------------------------------


def stripped(text_column: str) -> Column:
    """The text without what does not count."""
    return F.translate(F.coalesce(F.col(text_column), F.lit("")), WHITE_SPACE, "")


def digested(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """ENTRY for each row alone. `row` tells equal rows apart; store the result where it is
    read more than once, as it follows the layout of the input."""
    return docs.select(
        F.unhex(F.sha2(stripped(text_column).cast("binary"), 256)).alias("digest"),
        F.lit(1).cast("bigint").alias("n"),
        F.coalesce(F.length(text_column), F.lit(0)).cast("bigint").alias("chars"),
        F.col(id_column).cast("bigint").alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )


def folded(rows: DataFrame, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """ENTRY with at most one row for each digest and stretch of `fold_rows` digests of a task."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in stream:
            index.insert(*entries_of(batch))
            if len(index) >= fold_rows:
                yield from _entries(index)
                index = CuckooIndex()
        yield from _entries(index)

    return rows.mapInArrow(run, ENTRY)


def _entries(index: CuckooIndex) -> list[pa.RecordBatch]:
    return index.to_table().drop_columns(["buckets", "slot"]).to_batches()


def _sharded(entries: DataFrame, shards: int) -> DataFrame:
    """With the shard of each digest, from its first bits."""
    bits = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
    return entries.withColumn("shard", bits % shards)


def shards_for(entries: DataFrame, shard_rows: int = SHARD_ROWS) -> int:
    """So many that a shard gets about `shard_rows` rows, and every core has some."""
    least = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-entries.count() // shard_rows))


def build(entries: DataFrame, shards: int) -> DataFrame:
    """Index over the rows of ENTRY."""

    def run(keys, table):
        index = CuckooIndex(1 << (len(table) * 5 // (SLOTS * 4)).bit_length())
        index.insert(*entries_of(table))
        return _with_shard(index, keys[0].as_py())

    return _sharded(entries, shards).groupBy("shard").applyInArrow(run, INDEX)


def _with_shard(index: CuckooIndex, shard: int) -> pa.Table:
    table = index.to_table()
    return table.add_column(0, "shard", pa.array(np.full(len(table), shard)))


def insert(index: DataFrame, entries: DataFrame, shards: int) -> DataFrame:
    """The index with more rows of ENTRY. `shards` as it was built with."""

    def run(keys, old, new):
        held = CuckooIndex.from_table(old)
        held.insert(*entries_of(new))
        return _with_shard(held, keys[0].as_py())

    return _by_shard(index, _sharded(folded(entries), shards), run)


def delete(index: DataFrame, gone: DataFrame, left: DataFrame, shards: int) -> DataFrame:
    """The index without the rows `gone` (ENTRY, each of a live document). Where the row that
    stays is among them, the best of `left`, the documents that remain, takes its place."""

    def run(keys, old, new):
        held = CuckooIndex.from_table(old)
        once = CuckooIndex()
        once.insert(*entries_of(new))
        held.delete(*entries_of(once.to_table()))
        return _with_shard(held, keys[0].as_py())

    less = store(_by_shard(index, _sharded(folded(gone), shards), run), "dedup-index")
    orphans = less.where("chars < 0").select("digest")
    heirs = left.join(orphans, "digest", "left_semi").withColumn("n", F.lit(0).cast("bigint"))
    return insert(less, heirs, shards)


def _by_shard(index: DataFrame, entries: DataFrame, run) -> DataFrame:
    return index.groupBy("shard").cogroup(entries.groupBy("shard")).applyInArrow(run, INDEX)


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_rows: int = SHARD_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """For each row of `docs`: id, digest, n_group (rows with an equal text), keep_id (the id
    of the row of them that stays) and kept (whether it is this one)."""
    rows = store(digested(docs, id_column, text_column), "digests")
    entries = store(folded(rows), "digests")
    shards = shards_for(entries, shard_rows)
    groups = store(build(entries, shards), "dedup-index").select(
        F.col("digest").alias("key"), F.col("n").alias("n_group"), F.col("id").alias("keep_id"), F.col("row").alias("keep_row")
    )
    # more than 1 / hot_share of all rows each: at most `hot_share` of them, so a bounded table
    hot = F.col("n_group") > rows.count() / hot_share
    by_key = F.col("digest") == F.col("key")
    frequent = F.broadcast(groups.where(hot))
    held = rows.select("id", "digest", "row")
    common = held.join(frequent, by_key)
    others = held.join(frequent, by_key, "left_anti").join(groups.where(~hot), by_key)
    kept = F.col("row") == F.col("keep_row")
    return common.unionAll(others).select("id", "digest", "n_group", "keep_id", kept.alias("kept"))
