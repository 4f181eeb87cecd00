"""BPE encoding and decoding by tree concatenation, exact to the tokenizers library.

A text longer than ``LEAF`` characters is halved again and again, wherever the middle
falls; the halves are encoded together, in one parallel call, and put together pair by
pair up the tree. At a join, a window around the cut is encoded anew, together with its
two halves alone; it grows until both sides agree exactly: two or more tokens of the left
half's encoding must be at the same place in the window's, and likewise on the right (two,
as one at the window's very edge could be an artefact of the edge). A sequence of BPE tokens is the encoding of its text if every two neighbours are, and with a common
token on either side every two neighbours come from one encoding, so the result is that
of the whole text. If the window reaches both ends, it is the whole encoding itself.

Leaves are cut at white space into pieces that the tokenizer never merges across, and
pieces already seen are looked up, new ones are encoded many at a time; that is exact for the two kinds of tokenizer below
(any other gets whole leaves):

* byte level, its own regular expression, no normaliser: white space starts a piece;
* white space normalised and dropped: pieces are the runs between.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm._common import schema, small_batches, text_or_empty

LEAF = 8192
#: The first window has so many characters on either side of the cut.
WINDOW = 32
#: Pieces kept at hand: twice this many at most, those used last.
MAX_PIECES = 500_000
#: So many new pieces go to the library as one text, a special token between them.
TOGETHER = 128
#: Longer pieces are not kept.
MAX_PIECE = 64
#: Texts are encoded in groups of so many characters.
GROUP_CHARS = 1 << 21

#: The characters of Unicode's White_Space, which is what \s means to the tokenizers library.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = np.nonzero(a[:n] != b[:n])[0]
    return int(differ[0]) if len(differ) else n


class Encoder:
    """ids of whole texts for one tokenizer file, and texts of ids."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.window = leaf, window
        # the library takes these strings out of a text before anything else; so the text is cut there
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        pre, norm = spec.get("pre_tokenizer") or {}, json.dumps(spec.get("normalizer"))
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm == "null":
            self.pieces = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        elif '"\\\\s+"' in norm and pre.get("pretokenizers", [{}])[0].get("type") == "Split":
            self.pieces = re.compile(f"[^{WHITE}]+").findall
        else:
            self.pieces = lambda text: [text] if text else []
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.mark = next(iter(self.special), None)
        self.words = [self.tok.id_to_token(k) or "" for k in range(self.tok.get_vocab_size(True))]
        self.decoder = spec.get("decoder")

    def direct(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as little-endian uint32; none has a special token in it."""
        if self.mark is None:
            found = self.tok.encode_batch_fast(pieces, add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in found]
        together = [self.mark.join(pieces[k : k + TOGETHER]) for k in range(0, len(pieces), TOGETHER)]
        out = []
        for x in self.tok.encode_batch_fast(together, add_special_tokens=False):
            ids = np.array(x.ids, "<u4")
            raw, at = ids.tobytes(), 0
            for cut in np.nonzero(ids == self.special[self.mark])[0].tolist():
                out.append(raw[at : 4 * cut])
                at = 4 * cut + 4
            out.append(raw[at:])
        return out

    def _leaves(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > MAX_PIECES:
            self.before, self.known = self.known, {}
        known, before, cut = self.known, self.before, [self.pieces(t) for t in texts]
        new, long = [], {}
        for p in {p for ps in cut for p in ps if p not in known}:
            if p in before:
                known[p] = before[p]
            else:
                new.append(p)
        for at in range(0, len(new), 1 << 16):
            part = new[at : at + (1 << 16)]
            for piece, ids in zip(part, self._encode_pieces(part), strict=True):
                (known if len(piece) <= MAX_PIECE else long)[piece] = ids
        look = (lambda p: known[p] if p in known else long[p]) if long else known.__getitem__
        return [np.frombuffer(b"".join(map(look, ps)), "<u4") for ps in cut]

    def join(self, text: str, cut: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of ``text``, given those of its parts before and after ``cut``."""
        reach = self.window
        while True:
            a, b = max(0, cut - reach), min(len(text), cut + reach)
            while a and unicodedata.category(text[a])[0] == "M":  # it belongs to the character before
                a -= 1
            if a == 0 and b == len(text):
                return self.direct(text)
            w = self.direct(text[a:b])
            if a == 0:
                from_left, head = 0, left[:0]
            else:
                part = self.direct(text[a:cut])
                tail = _common(part[::-1], left[::-1])
                same = _common(w, part)
                from_left = len(part) - tail if same + tail > len(part) + 1 else -1
                head = left[: len(left) - tail]
            if b == len(text):
                to_right, rest = 0, right[:0]
            else:
                part = self.direct(text[cut:b])
                lead = _common(part, right)
                same = _common(w[::-1], part[::-1])
                to_right = len(part) - lead if same + lead > len(part) + 1 else -1
                rest = right[lead:]
            if from_left >= 0 and to_right >= 0 and from_left < len(w) - to_right:
                return np.concatenate([head, w[from_left : len(w) - to_right], rest])
            reach *= 2

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """ids (uint32) of each text, as the library's encode(text, add_special_tokens=False)."""
        cut = [self.special_at.split(t) if any(x in t for x in self.special) else [t] for t in texts]
        ids = iter(self._trees([part for parts in cut for part in parts if part not in self.special]))
        return [
            next(ids)
            if len(parts) == 1 and parts[0] not in self.special
            else np.concatenate([np.array([self.special[p]], np.uint32) if p in self.special else next(ids) for p in parts])
            for parts in cut
        ]

    def _trees(self, texts: list[str]) -> list[np.ndarray]:
        """ids of texts without special tokens in them."""

        def halve(a: int, b: int) -> list[tuple[int, int]]:
            if b - a <= self.leaf:
                return [(a, b)]
            return halve(a, (a + b) // 2) + halve((a + b) // 2, b)

        spans = [halve(0, len(t)) for t in texts]
        ids = iter(self._leaves([t[a:b] for t, s in zip(texts, spans, strict=True) for a, b in s]))
        out = []
        for text, span in zip(texts, spans, strict=True):
            parts = [(a, b, next(ids)) for a, b in span]
            while len(parts) > 1:  # neighbours that were halves of one stretch become it again
                joined = []
                for k in range(0, len(parts) - 1, 2):
                    (a, m, left), (_, b, right) = parts[k], parts[k + 1]
                    joined.append((a, b, self.join(text[a:b], m - a, left, right)))
                parts = joined + parts[len(parts) - len(parts) % 2 :]
            out.append(parts[0][2])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode(ids, skip_special_tokens=False)."""
        if self.decoder is None:  # the library then joins the tokens by one space
            return " ".join(map(self.words.__getitem__, ids.tolist()))
        return self.tok.decode(ids.tolist(), skip_special_tokens=False)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for the file, which every executor has at this path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about GROUP_CHARS characters, one text at least."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARS:
            yield at, k
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for each row; a null text is empty and has no id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            for a, b in groups(texts):
                found = enc.encode_many(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], _lists(found)], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, schema("doc_id long, ids array<int>"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); a null or empty list decodes to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [enc.decode(np.array(x.as_py() or [], np.uint32)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, schema("doc_id long, text string"))


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """A row of :data:`DIGEST` for each row of (doc_id, text): encoded, decoded, hashed.

    ``with_ids`` adds the ids themselves, as the column ids array<int>.
    In one pass without a shuffle. A null text is empty; empty texts have no token and the
    digests of the empty string; repeated rows and texts of any length have a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        numbers = list(map(str, range(len(enc.words))))
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            for a, b in groups(texts):
                found = enc.encode_many(texts[a:b])
                columns = {
                    "doc_id": batch.column(0)[a:b],
                    "n_tokens": pa.array([len(x) for x in found], pa.int64()),
                    "ids_sha256": pa.array([sha(" ".join(map(numbers.__getitem__, x.tolist()))) for x in found], pa.string()),
                    "decoded_sha256": pa.array([sha(enc.decode(x)) for x in found], pa.string()),
                }
                if with_ids:
                    columns["ids"] = _lists(found)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return small_batches(rows).mapInArrow(run, schema(DIGEST + ", ids array<int>" * with_ids))
