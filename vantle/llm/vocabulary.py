"""Whole texts to ids with the tokenizers library, unit by unit.

The library's own speed on running text is a few MB a second. A text's words
repeat, so each distinct unit is encoded by the library once per worker and the
text's ids are put together by lookup; texts whose white space makes unit borders
uncertain go to the library whole.
"""

from __future__ import annotations

import gc
import itertools
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LooseUnitTable, UnitTable, file_bytes, released, spans, text_arrays, texts_of


#: Letters of the Latin-1 range: one word piece for any pattern that parts letters from others, and unchanged by NFC.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class LibraryEncoder:
    """Texts to little-endian 32-bit ids by a tokenizer file's content.

    Plain words go to the library's BPE model directly, which is what its pipeline
    does with them in the end; signs and all other units through the whole pipeline.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True
        said = json.loads(content)
        pre, model = said.get("pre_tokenizer") or {}, said["model"]
        steps = pre.get("pretokenizers", [pre])
        normal = said.get("normalizer") or {}
        self.lower = self.direct = False
        self.model = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        whole_words = model.get("type") == "BPE" and not model.get("dropout") and not said.get("post_processor")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normal:
            self.table = UnitTable(self._units, self._whole)
            self.direct = whole_words
        elif any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") for s in steps):
            self.table = LooseUnitTable(self._units, self._whole)
            kinds = [n.get("type") for n in normal.get("normalizers", [])]
            if whole_words and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and kinds == ["NFC", "Replace", "Lowercase"] and "[\\p{L}]+" in steps[0]["pattern"]["Regex"]:
                self.direct = self.lower = True
        else:
            self.table = None

    def _model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of word pieces by the library's model alone, and how many each has. A blank before a word is part of it."""
        blank, model = self.letters[32], self.model
        spelt = [w.replace(" ", blank) if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        got = [[t.id for t in model(w)] for w in spelt]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum())), size

    def _library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the library's whole pipeline."""
        got = [e.ids for i in range(0, len(units), 4096) for e in self.tokenizer.encode_batch_fast(units[i : i + 4096], add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum())), size

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All units' ids in one array, and how many each has. A plain unit is a line feed or nothing, and a word."""
        if not self.direct:
            return self._library(units)
        words, word, feed, other, changed = self._lowered(units) if self.lower else self._prefixed(units)
        ids, size, order = [], np.zeros(len(words), np.int64), np.arange(len(words))
        if words and self.lower:
            # the table lacks all units, but may know a word that was not in lower case by now
            there, got, n = self.table.known([words[k] for k in changed.tolist()])
            there = changed[there]
            size[there] = n
            new = np.setdiff1d(order, there, assume_unique=True)
            made, size[new] = self._model([words[k] for k in new.tolist()] if len(there) else words)
            ids, order = [got, made], np.concatenate([there, new])
        elif words:
            made, size = self._model(words)
            ids = [made]
        for more in (other, ["\n"] if feed.any() else []):
            got, n = self._library(more)
            ids.append(got)
            order, size = np.concatenate([order, len(size) + np.arange(len(n))]), np.concatenate([size, n])
        size = np.append(size, 0)  # the last piece stands for nothing
        at = np.zeros(len(size), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        nothing = len(size) - 1
        piece = np.stack([np.where(feed, nothing - 1, nothing), np.where(word < 0, len(words) - 1 - word, word)], 1)
        return np.concatenate(ids)[spans(at[piece].ravel(), size[piece].ravel())], size[piece].sum(1)

    def _prefixed(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[str], np.ndarray]:
        """(distinct words, each unit's number there or -1 - its number in other, which have a line feed before the word, other units, words that aren't units)."""
        number: dict[str, int] = {}  # distinct words
        other: list[str] = []  # units that aren't of this form
        feeds, of = bytearray(len(units)), array("q")
        for k, unit in enumerate(units):
            word = unit
            if unit[:1] == "\n":
                word = unit[1:]
                feeds[k] = 1
            bare = word[1:] if word[:1] == " " else word
            if bare.isalpha() and (bare.isascii() or LATIN(bare)):
                of.append(number.setdefault(word, len(number)))
            else:
                of.append(-1 - len(other))
                other.append(unit)
                feeds[k] = 0
        return list(number), np.frombuffer(of, np.int64), np.frombuffer(feeds, np.uint8), other, np.empty(0, np.int64)

    def _lowered(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[str], np.ndarray]:
        """The same of units without white space, with words in lower case: ASCII words by Arrow's kernels."""
        names = pa.array(units, pa.large_string())
        plain = pc.ascii_is_alpha(names)
        of = np.empty(len(units), np.int64)
        at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        named = names.filter(plain)
        small = pc.ascii_lower(named)
        coded = small.dictionary_encode()
        words = coded.dictionary.to_pylist()
        of[at] = coded.indices.to_numpy()
        changed = np.unique(of[at[pc.not_equal(named, small).to_numpy(zero_copy_only=False)]])
        number: dict[str, int] = {}  # words of other letters
        other: list[str] = []
        for k in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist():
            unit = units[k]
            if unit.isalpha() and LATIN(unit):
                of[k] = len(words) + number.setdefault(unit.lower(), len(number))
            else:
                of[k] = -1 - len(other)
                other.append(unit)
        return words + list(number), of, np.zeros(len(units), np.uint8), other, np.concatenate([changed, len(words) + np.arange(len(number))])

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if self.table:
            return self.table.encode(texts)
        ids, size = self._library(texts.to_pylist() if isinstance(texts, pa.Array) else texts)
        return [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(size)[:-1])] if len(size) else []

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        if self.table:
            return self.table.counts(texts)
        return np.array([len(x) // 4 for x in self.encode(texts)], np.int64)


_ENCODERS: dict[int, LibraryEncoder] = {}


def encoder_of(content: bytes) -> LibraryEncoder:
    """One encoder per worker process and vocabulary, kept between tasks."""
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LibraryEncoder(content)
    gc.disable()  # until the task's end: the tables hold no cycles, and walking them costs more than it frees
    return _ENCODERS[key]


def token_counts(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens long) of every whole text, without special tokens; null text counts as empty."""
    content = df.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(content.value)
        for part, texts in text_arrays(batches):
            counts = encoder.counts(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, n_tokens long")


def crc_column(ids: str = "ids"):
    """crc32 of little-endian 32-bit ids held as binary."""
    return F.crc32(F.col(ids))
