"""BPE encoding and decoding by forced-boundary splitting.

A merge only ever joins bytes that stand next to each other inside some token of the vocabulary. A pair
of bytes that occurs inside no token is therefore a certain cut: no merge crosses it. White space is
such a cut everywhere, and so is every border between two matches of the vocabulary's split pattern;
inside a match, the table of byte pairs tells the rest. The fragments between cuts are encoded
independently (each distinct fragment once, in a table of bounded size) and their ids concatenated.
The result equals that of encoding the whole text.

Vocabulary files are those of the tokenizers library with a BPE model over byte characters; the path is
a parameter and must be readable on every executor (it comes with an installed package).

Defined results: a null text counts as empty and gives no ids; ids, extra columns and repeated rows of
the input are passed through or ignored as they are; the strings of special tokens inside a text become
those tokens, as in the library; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Distinct white-space fragments, and pieces of them, remembered by a Python worker (about 75 MB, by words of usual
#: length). A fragment that is one piece shares its entry.
MEMORY = 200_000

#: Texts that a worker turns into Python strings at once.
ROWS_AT_ONCE = 64

ODD = re.compile("[\x1c-\x1f]")

_OPEN: dict[str, "Vocabulary"] = {}


def byte_characters() -> dict[int, str]:
    """Bytes that print stand for themselves; the others get the characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {b: chr(b) for b in own}
    others = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """One vocabulary file: cuts, fragment ids, and tokens by id."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if not (split["behavior"] == "Removed" and split["invert"]):
            raise ValueError("the vocabulary must keep the matches of its split pattern")
        self.match = regex.compile(split["pattern"]["Regex"])
        self.steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) for m in model["merges"]]
        self.encoder = {}
        for last, suffix in ((True, {"end_of_word_suffix": self.suffix} if self.suffix else {}), (False, {})):
            self.encoder[last] = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, **suffix))
            self.encoder[last].pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.token = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        chars = byte_characters()
        self.char = [chars[b] for b in range(256)]
        self.joined = self._joined(model["vocab"])
        #: Ids of each remembered fragment, and what they decode to.
        self.known: dict[str, tuple[bytes, str]] = {}
        self.again: set[str] = set()
        self.pieces: dict[bool, dict[str, tuple[bytes, str]]] = {True: {}, False: {}}

    def _joined(self, vocab: Iterable[str]) -> frozenset[str]:
        """Pairs of byte characters that some token holds next to each other; between any others is a certain cut."""
        return frozenset(own[i:i + 2] for token in vocab
                         for own in [token.removesuffix(self.suffix) if self.suffix else token] for i in range(len(own) - 1))

    def normalised(self, text: str) -> str:
        if "NFC" in self.steps and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if "Lowercase" in self.steps:  # each character on its own: a sigma at a word's end is no case apart
            text = text.replace("Σ", "σ").lower()
        return text

    def _cut(self, fragment: str) -> list[list[str]]:
        """Matches of a fragment without white space, each as its pieces between certain cuts."""
        words, last = self.match.findall(fragment), self.pieces[True]
        if not (fragment.isascii() and fragment.isprintable()):
            words = ["".join([self.char[b] for b in w.encode("utf-8")]) for w in words]
        # A known last piece has no cut inside; most other words have none either.
        return [[w] if w in last or self.joined.issuperset(map(add, w, w[1:])) else self._apart(w) for w in words]

    def _apart(self, w: str) -> list[str]:
        cuts = [i for i in range(1, len(w)) if w[i - 1:i + 1] not in self.joined]
        return [w[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(w)])]

    def _merge(self, pieces: set[str], last: bool) -> None:
        """Encode pieces on their own, all in one call: the encoder takes each as a word."""
        known = self.pieces[last]
        new = list(pieces.difference(known))
        if new:
            coded = self.encoder[last].encode(" ".join(new), add_special_tokens=False)
            ids, tokens = np.array(coded.ids, "<u4").tobytes(), coded.tokens
            ends = np.cumsum(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new))).tolist()
            known.update((p, (ids[4 * lo:4 * hi], " ".join(tokens[lo:hi]))) for p, lo, hi in zip(new, [0, *ends], ends))

    def _learn(self, fragments: set[str]) -> None:
        new = fragments.difference(self.known)
        self.again |= fragments.difference(new)
        if max(len(self.known) + len(new), *map(len, self.pieces.values())) > MEMORY:
            # What was met again since the table was last cut stays, as far as it leaves half of the table free.
            kept = self.again if len(self.again) <= MEMORY // 2 else fragments.difference(new)
            self.known, self.again = {f: self.known[f] for f in kept}, set()
            for table in self.pieces.values():
                table.clear()
        cut = [(f, self._cut(f)) for f in new]
        self._merge({w[-1] for _, words in cut for w in words}, True)
        self._merge({p for _, words in cut for w in words if len(w) > 1 for p in w[:-1]}, False)
        inner, last = self.pieces[False], self.pieces[True]
        for f, words in cut:
            if len(words) == 1 and len(words[0]) == 1:
                self.known[f] = last[words[0][0]]
            else:
                coded = [part for w in words for part in (*[inner[p] for p in w[:-1]], last[w[-1]])]
                self.known[f] = b"".join([ids for ids, _ in coded]), " ".join([text for _, text in coded if text])

    def _parts(self, text: str | None) -> list[tuple[int | None, list[str]]]:
        """The text as special tokens and lists of fragments."""
        text, out = text or "", []
        for k, part in enumerate(self.special_cut.split(text) if self.special else [text]):
            if k % 2:
                out.append((self.special[part], []))
            else:
                part = self.normalised(part)
                # str.split takes four control characters for white space that the pattern does not.
                odd = ODD.search(part)
                out.append((None, re.findall(r"(?:[^\s]|[\x1c-\x1f])+", part) if odd else part.split()))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.token[i] for i in ids])

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text, its ids as little-endian unsigned 32-bit integers, and what they decode to."""
        cut, out = [self._parts(t) for t in texts], []
        self._learn(set().union(*[fragments for parts in cut for _, fragments in parts]))
        for parts in cut:
            ids, decoded = [], []
            for special, fragments in parts:
                if special is not None:
                    ids.append(special.to_bytes(4, "little"))
                    decoded.append(self.token[special])
                if fragments:
                    own, texts_of = zip(*map(self.known.__getitem__, fragments))
                    ids += own
                    decoded += filter(None, texts_of)
            out.append((b"".join(ids), " ".join(decoded)))
        return out


def vocabulary(path: str) -> Vocabulary:
    if path not in _OPEN:
        _OPEN[path] = Vocabulary(path)
    return _OPEN[path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(lo, ROWS_AT_ONCE)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int): the encoding of every whole text."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in _slices(batches):
            rows = [np.frombuffer(ids, dtype="<i4") for ids, _ in words.encode(part.column(text_col).to_pylist())]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.concatenate([*rows, np.empty(0, "<i4")]))
            yield pa.RecordBatch.from_arrays([part.column(id_col), ids], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text: tokens of the ids joined by blanks, as the library decodes a vocabulary without decoder."""
    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in _slices(batches):
            texts = [words.decode(ids or []) for ids in part.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, without keeping the ids."""
    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in _slices(batches):
            coded = words.encode(part.column(text_col).to_pylist())
            columns = [pa.array([len(ids) // 4 for ids, _ in coded], pa.int64()),
                       pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in coded], pa.string()),
                       pa.array([hashlib.sha256(text.encode("utf-8")).hexdigest() for _, text in coded], pa.string())]
            yield pa.RecordBatch.from_arrays([part.column(id_col), *columns], names=schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, path: str, carry: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``carry`` of every row, with n_tokens, ids and decoded_sha256 of its whole text."""
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
             T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([*(docs.schema[c] for c in carry), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in _slices(batches):
            coded = words.encode(part.column(text_col).to_pylist())
            rows = [np.frombuffer(ids, dtype="<i4") for ids, _ in coded]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array([len(r) for r in rows], pa.int64()),
                 pa.ListArray.from_arrays(ends, np.concatenate([*rows, np.empty(0, "<i4")])),
                 pa.array([hashlib.sha256(text.encode("utf-8")).hexdigest() for _, text in coded], pa.string())],
                names=schema.fieldNames())

    return docs.select(*carry, text_col).mapInArrow(run, schema)
