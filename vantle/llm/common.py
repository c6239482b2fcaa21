"""What the training-data operators share: column hygiene, Arrow batches, shared storage."""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder, written  # noqa: F401  used by the operators

#: Rows and bytes that one Arrow batch may hold on its way to a Python worker.
ARROW_ROWS, ARROW_BYTES = 4096, 8 << 20


def bound_arrow(spark: SparkSession, most: int = ARROW_BYTES) -> None:
    """Keep Arrow batches small, so that a few very long texts don't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) alone: null text becomes empty, other columns can't clash."""
    bound_arrow(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # another C library


def release() -> None:
    """What a task does at its end: give freed memory back, and collect cycles again if it didn't."""
    gc.enable()
    trim()


def released(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, with the memory that its task freed given back at its end: workers live on and share an executor."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts hold about ``most`` bytes, with the texts as Python strings."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows and texts.nbytes > most:
            step = max(1, int(batch.num_rows * most // texts.nbytes))
        else:
            step = max(1, batch.num_rows)
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, part.column(part.schema.get_field_index(column)).to_pylist()


def text_arrays(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Like text_batches, with the texts left as an Arrow array."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        step = max(1, int(batch.num_rows * most // max(texts.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, part.column(part.schema.get_field_index(column))


def keep_rows(df: DataFrame, decide: Callable[[list[str]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows whose text ``decide`` keeps, with all their columns; null text counts as empty.

    Rows pass through whole, so nothing is joined and no column name can clash.
    """
    bound_arrow(df.sparkSession)
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            kept = part.filter(pa.array(decide(texts), pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0)], names=["row"])

    return rows.mapInArrow(released(run), T.StructType([T.StructField("row", df.schema)])).select("row.*")


def file_bytes(path: str) -> bytes:
    """A local vocabulary file of the driver; its content goes to the workers by broadcast."""
    with open(path, "rb") as file:
        return file.read()


class Kept:
    """Unit strings with their ids: a dictionary of places in one growing array of ids."""

    def __init__(self) -> None:
        #: start << 32 | number of ids; ODD for a unit that only the whole text can settle
        self.places: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = self.chars = 0

    def add(self, units: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Enter units whose ids follow each other in ``ids``; their places."""
        total = len(ids)
        if self.used + total > len(self.ids):
            wider = np.empty(max(2 * len(self.ids), self.used + total), np.uint32)
            wider[: self.used] = self.ids[: self.used]
            self.ids = wider
        self.ids[self.used : self.used + total] = ids
        places = (self.used + np.cumsum(size) - size) << 32 | size
        self.used += total
        self.places.update(zip(units, places.tolist(), strict=True))
        self.chars += sum(map(len, units))
        return places


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of every row, one row after the other."""
    reach = np.cumsum(size)
    total = int(reach[-1]) if len(reach) else 0
    if total < 1 << 31 and (not len(start) or int(start.max()) < 1 << 31):
        return np.repeat((start - (reach - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)
    return np.repeat(start - (reach - size), size) + np.arange(total)


#: ASCII signs but the apostrophe. Behind a letter or digit a run of them is a piece of its own for any
#: encoder that parts letters and digits from signs.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


IS_SIGN = np.zeros(256, bool)
IS_SIGN[list(SIGNS.encode())] = True
#: 1 for an ASCII letter or digit, 0 for another ASCII byte, 2 for a byte of a longer letter
LAST = np.array([2 if b > 127 else int(chr(b).isalnum()) for b in range(256)], np.int8)


def strings(start: np.ndarray, size: np.ndarray, raw: np.ndarray) -> pa.Array:
    """An Arrow array of the byte ranges of ``raw``, each valid UTF-8."""
    ends = np.concatenate([[0], np.cumsum(size)])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(raw[spans(start, size)])])


def cut_signs(units: pa.Array, bare_alone: bool) -> tuple[pa.Array, pa.Array]:
    """(units without the signs at their end, those signs), uncut where the signs may go together with what is before them.

    They go alone behind a letter or digit, and if ``bare_alone`` behind nothing.
    """
    units = units.cast(pa.large_string())
    offsets = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units) + 1]
    raw = np.frombuffer(units.buffers()[2] or b"\0", np.uint8)
    start, size = offsets[:-1], np.diff(offsets)
    left = size.copy()
    todo = np.flatnonzero(left)
    while len(todo):  # one sign a round, of the units that still end with one
        todo = todo[IS_SIGN[raw[start[todo] + left[todo] - 1]]]
        left[todo] -= 1
        todo = todo[left[todo] > 0]
    cut = np.flatnonzero(left < size)
    some = cut[left[cut] > 0]
    last = LAST[raw[start[some] + left[some] - 1]]
    apart = last == 1
    for k in np.flatnonzero(last == 2).tolist():
        at = int(start[some[k]])
        sign = raw[at : at + int(left[some[k]])].tobytes().decode("utf-8", "replace")[-1]
        apart[k] = sign.isalnum() and sign < "\u0530"
    joined = np.concatenate([some[~apart], np.empty(0, np.int64) if bare_alone else cut[left[cut] == 0]])
    left[joined] = size[joined]
    return strings(start, left, raw), strings(start + left, size - left, raw)


class UnitTable:
    """Encodings of text units, each computed once per worker and looked up afterwards.

    A unit is a run without white space, with the one blank or line feed before it.
    Encoders that never look across such a border, nor from a letter or digit to a sign
    behind it, give the same result piece by piece as for the whole text. Texts with any
    other white space layout (double blanks, tabs, ...) are left to ``whole``.

    A batch is cut in units, and its distinct units are found and parted from the signs at
    their end by Arrow's kernels; only what is distinct then becomes Python strings, and
    the texts' ids are gathered by arrays.

    encode_units: list of unit strings -> all their ids in one array, and how many each has
    whole: text -> bytes
    limit, limit_chars: units and their characters kept. They are held in two
    generations of half that size: when the young one is full it becomes the old one,
    and the former old one goes. A unit found in the old one moves to the young one,
    so frequent units stay and those not met for long are dropped.
    """

    #: what a line feed becomes before texts are cut at blanks
    LINE = " \n"
    MISSING, ODD = -1, -2

    def __init__(self, encode_units: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], whole: Callable[[str], bytes], limit: int = 800_000, limit_chars: int = 32 << 20):
        self.encode_units, self.whole, self.limit, self.limit_chars = encode_units, whole, limit, limit_chars
        self.young, self.old = Kept(), Kept()

    def known(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which keys were met before, their ids in one array, how many each of them has)."""
        missing = itertools.repeat(self.MISSING)
        young, old = (np.fromiter(map(kept.places.get, keys, missing), np.int64, len(keys)) for kept in (self.young, self.old))
        there = np.flatnonzero((young >= 0) | (old >= 0))
        offset = np.where(young[there] >= 0, 0, len(self.young.ids))
        place = np.where(young[there] >= 0, young[there], old[there])
        size = place & 0xFFFFFFFF
        return there, np.concatenate([self.young.ids, self.old.ids])[spans((place >> 32) + offset, size)] if len(there) else np.empty(0, np.uint32), size

    def _first(self, index: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """Units that a text begins with have no blank before them: in ``index`` they become units of their own behind the ``n`` others; which they are."""
        heads, which = np.unique(index[starts], return_inverse=True)
        index[starts] = n + which
        return heads

    #: what stands before the key of a piece that has no blank before it
    NO_BLANK = " "
    #: whether signs without a word are a piece of their own, whatever is before them
    SIGNS_ALONE = False

    def _odd(self, key: str) -> bool:
        """Whether only the whole text can settle it."""
        bare = key[1:] if key[:1] in " \n" else key
        return bare.split() != [bare]

    def _unit(self, key: str) -> str:
        return key[1:] if key[0] == " " else key if key[0] == "\n" else " " + key

    def _learn(self, keys: list[str]) -> np.ndarray:
        """Places of keys that neither generation holds."""
        odd = np.fromiter(map(self._odd, keys), bool, len(keys))
        places = np.full(len(keys), self.ODD)
        if odd.any():
            self.young.places.update(dict.fromkeys((k for k, o in zip(keys, odd.tolist(), strict=True) if o), self.ODD))
            keys = [k for k, o in zip(keys, odd.tolist(), strict=True) if not o]
        places[~odd] = self.young.add(keys, *self.encode_units(list(map(self._unit, keys))))
        return places

    def _places(self, words: list[str]) -> np.ndarray:
        """Places in the young generation of distinct keys, ODD for those that only the whole text can settle."""
        if len(self.young.places) > self.limit // 2 or self.young.chars > self.limit_chars // 2:
            self.young, self.old = Kept(), self.young
        missing = itertools.repeat(self.MISSING)
        places = np.fromiter(map(self.young.places.get, words, missing), np.int64, len(words))
        todo = np.flatnonzero(places == self.MISSING)
        if len(todo) and self.old.places:
            keys = [words[k] for k in todo.tolist()]
            had = np.fromiter(map(self.old.places.get, keys, missing), np.int64, len(keys))
            there = np.flatnonzero(had >= 0)
            if len(there):
                at, size = had[there] >> 32, had[there] & 0xFFFFFFFF
                places[todo[there]] = self.young.add([keys[k] for k in there.tolist()], self.old.ids[spans(at, size)], size)
            todo = todo[had < 0]
        if len(todo):
            places[todo] = self._learn([words[k] for k in todo.tolist()])
        return places

    def _pieces(self, units: pa.Array, used: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of each used unit's two pieces: the unit without the signs at its end, and the signs. blank: units with a blank before them."""
        bare, signs = cut_signs(units, self.SIGNS_ALONE)
        coded = bare.dictionary_encode()
        names, of = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        ends = signs.dictionary_encode()
        if self.NO_BLANK and not blank.all():
            # a key stands for a piece with a blank before it, or for one without
            number = np.full(2 * len(names), -1)
            asked = of + np.where(blank, 0, len(names))
            keys = np.unique(asked[used])
            number[keys] = np.arange(len(keys))
            of = number[asked]
            texts = [names[k] if k < len(names) else self.NO_BLANK + names[k - len(names)] for k in keys.tolist()]
        else:
            texts = names
        tails = ends.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = self._places(texts + [self.NO_BLANK + t for t in tails if t])
        tail = np.zeros(len(tails), np.int64)
        tail[[k for k, t in enumerate(tails) if t]] = places[len(texts) :]
        return places[of], tail[ends.indices.to_numpy()]

    def _look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all distinct units, where those of each unit of all texts start there, how many they are, end of each text's units, which texts are to be encoded whole)."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", self.LINE), " ")
        ends = np.cumsum(pc.list_value_length(parts).to_numpy())
        starts = np.concatenate([[0], ends[:-1]])
        coded = parts.flatten().dictionary_encode()
        units, index = coded.dictionary, coded.indices.to_numpy().astype(np.int32)
        n = len(units)
        heads = self._first(index, starts, n)
        if len(heads):
            units = pa.concat_arrays([units, units.take(pa.array(heads))])
        used = np.bincount(index, minlength=len(units)) > 0
        word, tail = self._pieces(units, used, np.arange(len(units)) < n)
        odd = used & (word < 0)
        whole = np.logical_or.reduceat(odd[index], starts) if odd.any() else np.zeros(len(texts), bool)
        pieces = np.where((used & ~odd)[:, None], np.stack([word, tail], 1), 0)
        size = pieces & 0xFFFFFFFF
        ids = self.young.ids[spans((pieces >> 32).ravel(), size.ravel())]
        size = size.sum(1)
        at = np.cumsum(size) - size
        return ids, at[index], size[index], ends, whole

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Each text's encoding."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return []
        ids, at, size, ends, whole = self._look_up(texts)
        raw = ids[spans(at, size.astype(np.int32))].tobytes()
        stops = (4 * np.cumsum(size)[ends - 1]).tolist()
        out = [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        for k in np.flatnonzero(whole).tolist():
            out[k] = self.whole(texts[k].as_py())
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        if not len(texts):
            return np.empty(0, np.int64)
        _, _, size, ends, whole = self._look_up(texts)
        out = np.diff(np.concatenate([[0], np.cumsum(size)[ends - 1]]))
        for k in np.flatnonzero(whole).tolist():
            out[k] = len(self.whole(texts[k].as_py())) // 4
        return out


class LooseUnitTable(UnitTable):
    """For encoders that drop white space: every blank and line feed is a border, whatever surrounds it."""

    LINE = " "
    NO_BLANK, SIGNS_ALONE = "", True

    def _first(self, index: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        return np.empty(0, np.int64)

    def _odd(self, key: str) -> bool:
        return False

    def _unit(self, key: str) -> str:
        return key