"""Personal data: fixed patterns, and spans that a linear-chain CRF adds.

The CRF labels white-space-separated words from their shapes (letters and digits reduced to
classes, a few cue words), those of their neighbours, and label transitions. It is trained
on the small table :data:`LABELLED` by gradient ascent of the conditional likelihood, on the
driver; its weights are a few kilobytes and go to the tasks with the function.

Decoding is Viterbi over whole documents, in numpy batches. In a run of words of plain shape,
a word some way in is O on the best path whatever surrounds the run; how far in is proved from
the weights when the model is made (:meth:`Crf.reach`). The best path of a document is that of
its pieces between such words, so only the stretches around other words are decoded, many at
a time; the labels are those of the whole document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm._common import schema, small_batches, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the CRF finds come after them.
ALL_KINDS = (*KINDS, "secret")
LABELS = ("O", "email", "phone", "secret")

#: Sentences with [kind words] marked; what is not marked is no personal data.
LABELLED = """
call me at [phone (408) 555-0163] after six
our office [phone (212) 555-0148] is open
phone: [phone 555-867-5309] or come by
tel. [phone 0171-5557788] daily
ring [phone 415.555.0132] for help
the number is [phone (030) 5551234] in town
fax [phone 212-555-0199] please
dial [phone 020-7946-0958] now
mobile [phone 555-0123-456] only
reach her by phone [phone 646-555-0176] today
(call [phone (503) 555-0101] first)
tel [phone (617) 555-0177] and ask
contact [phone 312-555-0143] today
numbers [phone 718-555-0111] and [phone 718-555-0112] both work
write to [email jane.doe [at] example [dot] org] soon
mail [email bob [at] example [dot] com] about it
contact [email info [at] mail7 [dot] example] there
email [email max (at) example (dot) net] today
email: [email sales (at) example (dot) org] now
my address [email lee_99 [at] example [dot] com] works
reply to [email h.r [at] firm [dot] example] please
token = [secret "8a67639f74080f56c5aa328f676226e236a23e23"] and
the token = [secret "8e3b1c77fc4c011f1bd38f1f34920fbd01f40072"] was
key = [secret "e3cf347862554017cdf83fd989e60f210402362d"] here
password = [secret "53c9efc6d892aa68bfcc8c928344b16103485a1c"] stays
secret: [secret 1f3d0201bfe8c26b715568b9126bef73fecde3b5] end
TOKEN = [secret "292BE01E4FC2D031C41885221C25F6AAF76FDC6C"] big
token = [secret "369aad6b68b75b48e99f73f289509dddc3ebffc5"] nicht
api_key = [secret "ccd8099ee02cab83bb43e451f9ab2845ad0f3d76"] used
the year 1998 was good
in 2004-2005 they met
from 10-12 people came
licensed under CC BY-NC 4.0. all rights
version 3. or later
about 1,234,567 rows (3 of 12) were read
pages 120-130 and 200-210 of it
on 2020-01-31 at 23:50 it ended
the score was 3-2 (2-1) at last
it costs 12.50 or 1.200,00 here
see section 4.2.1 and table 7
order 7311820465599013 was sent
the id 2840067713945527 is not it
at noon he was at home
the dot at the end of it
they met at example road
a list [at] the end
items (a) and (b) of part 2
room 101 at 9 and room 202 at 10
he wrote key = value here
token = none was set
"quoted" words and "others" stand
the and of to in with for that
thntblere of then edtioner in inea
call the man in the house
call it a day and mail it
phone and mail are down
the phone rang at ten
x-ray 5 and u-boat 96 sank
isbn 978-3-16-148410-0 is a book
1-2-3 and 10-20-30 are dates
range 1000-2000 or 100-200-300 units
commit 24be644 was fine
hash 9f86d081 of it
serial AB-1234-CD was read
THE AND OF TO IN WITH FOR THAT
from 192.168.0.1 to 10.0.0.1 it went
he said 50% or $20 or #7 was it
"""

_MARK = re.compile(r"\[(" + "|".join(LABELS[1:]) + r") ")
_CUES = {
    **dict.fromkeys(("call", "phone", "tel", "ring", "fax", "dial", "mobile", "contact", "number", "numbers", "reach"), "call"),
    **dict.fromkeys(("email", "mail", "write", "reply", "address"), "mail"),
    **dict.fromkeys(("token", "key", "password", "secret", "api_key"), "key"),
}


_HEX = "\x01"


def word_key(word: str) -> str:
    """What the CRF sees of a word: a cue, or its shape.

    Runs of hexadecimal digits of 20 or more are one mark; runs of letters a, of digits their
    number up to 5; other characters stay, runs of one written once.
    """
    bare = word.strip(".,:;!?()")
    if bare.isalpha() and "(" not in word:
        return _CUES.get(bare.lower(), "a")
    if bare.lower() in _CUES:
        return _CUES[bare.lower()]
    if word.lower() in ("[at]", "(at)", "[dot]", "(dot)"):
        return word.lower()[1:-1]
    shape = re.sub(r"[0-9a-fA-F]{20,}", _HEX, word)
    shape = re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 5)), re.sub(r"[^\W\d_]+|_+", "a", shape))
    shape = re.sub(r"([^\w])\1+", r"\1", shape)
    bare = re.sub(r"[.,:;!?#*$%&|<>]+$", "", shape)
    return "a" if re.fullmatch(r"[^\w\[(\x01]*(?:a[^\w\[(\x01]*)*", bare) else bare


def _rows() -> list[tuple[list[str], list[int]]]:
    rows = []
    for line in LABELLED.strip().split("\n"):
        words, labels = [], []
        at = 0
        while at < len(line):
            if m := _MARK.match(line, at):
                depth, end = 0, m.end()
                while depth or line[end] != "]":
                    depth += {"[": 1, "]": -1}.get(line[end], 0)
                    end += 1
                for w in line[m.end() : end].split():
                    words.append(w)
                    labels.append(LABELS.index(m[1]))
                at = end + 1
            else:
                stop = line.find(" ", at) if line[at] != " " else at
                stop = len(line) if stop < 0 else stop
                if m2 := _MARK.search(line, at, stop):
                    stop = m2.start()
                if w := line[at:stop].strip():
                    words.append(w)
                    labels.append(0)
                at = max(stop, at + 1)
        rows.append((words, labels))
    return rows


class Crf:
    """Weights by word key for a word, its predecessor and its successor, and transitions."""

    #: Outside a document, and any key that training never saw.
    EDGE, RARE = "^", "?"

    def __init__(self, keys: list[str]):
        self.keys = {k: i for i, k in enumerate(keys)}
        self.emit = np.zeros((3, len(keys), len(LABELS)))
        self.trans = np.zeros((len(LABELS), len(LABELS)))
        #: Words of a stretch to either side of its words that are not plain.
        self.margin = 0

    def index(self, key: str) -> int:
        return self.keys.get(key, self.keys[self.RARE])

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Emission scores of sequences [n, t]; the first and last words are edges of the stretch."""
        out = self.emit[0][ids]
        out[:, 1:] += self.emit[1][ids[:, :-1]]
        out[:, :-1] += self.emit[2][ids[:, 1:]]
        return out

    def reach(self, most: int = 16) -> int:
        """The smallest R so that a plain word with R plain-between-plain words on either side is O.

        Given the labels before and after such a run, its best path doesn't depend on
        anything else, so trying all pairs of them proves it.
        """
        score = self.emit[:, self.keys["a"]].sum(axis=0)
        for r in range(1, most + 1):
            middles = set()
            for before in range(len(LABELS)):
                best, back = self.trans[before] + score, []
                for _ in range(2 * r):
                    through = best[:, None] + self.trans
                    back.append(through.argmax(axis=0))
                    best = through.max(axis=0) + score
                for after in range(len(LABELS)):
                    at = int((best + self.trans[:, after]).argmax())
                    for k in range(2 * r - 1, r - 1, -1):
                        at = int(back[k][at])
                    middles.add(at)
            if middles == {0}:
                return r
        raise RuntimeError("plain words are not certain; documents can't be cut at them")

    def viterbi(self, ids: np.ndarray) -> np.ndarray:
        """Best labels of equally long sequences [n, t] whose first and last words are O."""
        score = self.scores(ids)
        score[:, [0, -1], 1:] = -np.inf
        n, t, s = score.shape
        best, back = score[:, 0].copy(), np.zeros((t, n, s), np.int8)
        for k in range(1, t):
            through = best[:, :, None] + self.trans[None]
            back[k] = through.argmax(axis=1)
            best = through.max(axis=1) + score[:, k]
        out = np.zeros((n, t), np.int8)
        out[:, -1] = best.argmax(axis=1)
        for k in range(t - 1, 0, -1):
            out[:, k - 1] = back[k][np.arange(n), out[:, k]]
        return out


def train(rows: list[tuple[list[str], list[int]]], rounds: int = 300, rate: float = 0.1, decay: float = 0.002) -> Crf:
    """A CRF by Adam on the mean log-likelihood less a quadratic penalty; deterministic.

    Keys seen once also train the weights of unseen keys (RARE).
    """
    keyed = [[Crf.EDGE, *map(word_key, w), Crf.EDGE] for w, _ in rows]
    golds = [[0, *g, 0] for _, g in rows]
    crf = Crf(sorted({k for ks in keyed for k in ks} | {Crf.RARE, "a"}))
    # a third of the table once more with its rare words unknown
    count: dict[str, int] = {}
    for ks in keyed:
        for k in ks:
            count[k] = count.get(k, 0) + 1
    seqs = [([crf.index(k) for k in ks], g) for ks, g in zip(keyed, golds, strict=True)]
    seqs += [([crf.index(k if count[k] > 1 else Crf.RARE) for k in ks], g) for ks, g in list(zip(keyed, golds, strict=True))[::3] if not any(g)]
    seqs += [([crf.index("a")] * 8, [0] * 8)] * 20
    m = [np.zeros_like(crf.emit), np.zeros_like(crf.trans)]
    v = [np.zeros_like(crf.emit), np.zeros_like(crf.trans)]
    for step in range(1, rounds + 1):
        grad = [-decay * crf.emit, -decay * crf.trans]
        for ids, gold in seqs:
            ids = np.array(ids)
            score = crf.scores(ids[None])[0]
            t, s = score.shape
            fwd, bwd = np.zeros((t, s)), np.zeros((t, s))
            fwd[0] = score[0]
            for k in range(1, t):
                x = fwd[k - 1][:, None] + crf.trans
                fwd[k] = np.logaddexp.reduce(x, axis=0) + score[k]
            for k in range(t - 2, -1, -1):
                bwd[k] = np.logaddexp.reduce(crf.trans + score[k + 1] + bwd[k + 1], axis=1)
            total = np.logaddexp.reduce(fwd[-1])
            diff = -np.exp(fwd + bwd - total)
            diff[np.arange(t), gold] += 1
            w = 1 / len(seqs)
            np.add.at(grad[0][0], ids, w * diff)
            np.add.at(grad[0][1], ids[:-1], w * diff[1:])
            np.add.at(grad[0][2], ids[1:], w * diff[:-1])
            pair = fwd[:-1, :, None] + crf.trans[None] + (score + bwd)[1:, None, :] - total
            grad[1] -= w * np.exp(pair).sum(axis=0)
            np.add.at(grad[1], (np.array(gold[:-1]), np.array(gold[1:])), w)
        for p, g, mm, vv in zip((crf.emit, crf.trans), grad, m, v, strict=True):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            p += rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return crf


@lru_cache(maxsize=1)
def model() -> Crf:
    """The CRF of the whole table; the same on every run."""
    crf = train(_rows())
    crf.margin = crf.reach() + 2
    return crf


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DOMAIN = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LUHN = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the longest run of local-part characters before it; linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(_LUHN[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], ALL_KINDS.index(s[0]), s[2]))


#: Words that are known to be plain.
_plain: set[str] = set()
BATCH_CELLS = 1 << 16


def crf_spans(texts: list[str], crf: Crf) -> list[list[tuple[str, int, int]]]:
    """The CRF's spans of each text, words' outer punctuation left out."""
    plain, edge = crf.keys["a"], crf.keys[Crf.EDGE]
    stretches: list[tuple[int, list[tuple[int, int]], list[int]]] = []
    for no, text in enumerate(texts):
        words = _WORD.findall(text)
        ids, odd = [plain] * len(words), []
        for i in [i for i, w in enumerate(words) if w not in _plain]:
            w = words[i]
            if (k := crf.index(word_key(w))) != plain:
                ids[i] = k
                odd.append(i)
            elif len(_plain) < 500_000 and len(w) <= 64:
                _plain.add(w)
        if not odd:
            continue
        odd = np.array(odd)
        spans = [m.span() for m in _WORD.finditer(text)]
        for part in np.split(odd, np.nonzero(np.diff(odd) > 2 * crf.margin)[0] + 1):
            a, b = int(part[0]) - crf.margin, int(part[-1]) + crf.margin + 1
            inner = ids[max(a, 0) : b]
            at = spans[max(a, 0) : b]
            stretches.append((no, [(0, 0)] * (a < 0) + at + [(0, 0)] * (b > len(ids)), [edge] * (a < 0) + inner + [edge] * (b > len(ids))))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    by_length: dict[int, list[int]] = {}
    for k, s in enumerate(stretches):
        by_length.setdefault(len(s[2]), []).append(k)
    for length, members in by_length.items():
        step = max(1, BATCH_CELLS // length)
        for at in range(0, len(members), step):
            part = members[at : at + step]
            labels = crf.viterbi(np.array([stretches[k][2] for k in part], np.int32))
            for k, row in zip(part, labels, strict=True):
                no, spans, _ = stretches[k]
                for begin in np.nonzero((row > 0) & np.insert(row[1:] != row[:-1], 0, True))[0]:
                    end = begin
                    while end + 1 < len(row) and row[end + 1] == row[begin]:
                        end += 1
                    a, b = spans[begin][0], spans[end][1]
                    kept = texts[no][a:b]
                    head = len(kept) - len(kept.lstrip("\"'.,:;!?#*$%&|<>"))
                    tail = len(kept) - len(kept.rstrip("\"'.,:;!?#*$%&|<>"))
                    if head + tail < len(kept):
                        out[no].append((LABELS[row[begin]], a + head, b - tail))
    return out


def find(texts: list[str], crf: Crf) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; a CRF span that meets a base span is left out."""
    out = []
    for text, more in zip(texts, crf_spans(texts, crf), strict=True):
        base = base_spans(text)
        added = [s for s in more if not any(s[1] < b[2] and b[1] < s[2] for b in base)]
        out.append((base, sorted(base + added, key=lambda s: (s[1], ALL_KINDS.index(s[0]), s[2]))))
    return out


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """A row of :data:`RESULT` for each document, in one pass without a shuffle.

    The counts are of base spans; ``spans`` has those of the CRF too. Null and empty texts
    have none; repeated rows have a row each; other columns are not read.
    """
    crf = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find([t.as_py() for t in batch.column(1)], crf)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in found], pa.string()),
                    pa.array([_listed(a) for _, a in found], pa.string()),
                    pa.array([len(a) - len(b) for b, a in found], pa.int64()),
                ],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return small_batches(rows).mapInArrow(run, schema(RESULT))


def redact(docs: DataFrame, mask: str = "[{kind}]") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``mask``; overlapping spans are one."""
    crf = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t.as_py() for t in batch.column(at)]
            new = []
            for text, (_, spans) in zip(texts, find([t or "" for t in texts], crf), strict=True):
                if text is not None:
                    parts, end = [], 0
                    for kind, a, b in spans:
                        if a >= end:
                            parts += [text[end:a], mask.format(kind=kind)]
                        end = max(end, b)
                    text = "".join(parts) + text[end:]
                new.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, pa.string()))

    return small_batches(docs).mapInArrow(run, docs.schema)
