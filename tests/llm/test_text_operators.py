"""Operators that work text by text, against brute force and the libraries they must equal."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tripwright.llm import bpe, chat, html_extract, pii, quality, simhash_dedup, token_files

P = pytest.importorskip("public_tokenizers")

EDGES = ["", " ", "\n", "a", "a\x0bb\x85c é", "x y z x y z", "x\n\nx\n x", "word " * 400, "\x00\ud83d".encode("utf-8", "replace").decode()]


def _shingle_brute(text, n=3):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [*EDGES, "One TWO three Four five", "É ß 日本 word word word"])
def test_fingerprint(text):
    assert simhash_dedup.fingerprint(text) == _shingle_brute(text)


def test_fingerprint_slices(monkeypatch):
    monkeypatch.setattr(simhash_dedup, "SLICE", 3)
    text = " ".join(f"w{k % 7}" for k in range(50))
    assert simhash_dedup.fingerprint(text) == _shingle_brute(text)


def _stats_brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_stats():
    rng = random.Random(1)
    texts = EDGES + ["".join(rng.choice("ab \n#|é\t") for _ in range(rng.randrange(80))) for _ in range(400)]
    assert all(quality.base_stats(t) == _stats_brute(t) for t in texts)


def test_quality_ratio_and_threshold():
    target, corpus = np.zeros(1 << 16), np.zeros(1 << 16)
    for text, good in (("the cat sat on the mat " * 5, True), ("### %%% $$$ " * 9, False)):
        for b in quality.ngram_buckets(text.encode()):
            n = np.bincount(b, minlength=1 << 16)
            corpus += n
            target += n * good
    model = quality.Model(quality.ratios_of(target, corpus))
    assert model.score("the cat sat") > 0 > model.score("$$$ ###") and model.score("") == 0
    assert quality.choose_threshold(np.array([3.0, 2.0, -1.0, -2.0]), np.array([True, True, False, False])) == 0.5
    assert quality.choose_threshold(np.array([1.0]), np.array([True])) == float("-inf")
    halves = list(quality.ngram_buckets(b"abcdefgh"))
    assert sum(map(len, halves)) == 5


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_library(name):
    rng = random.Random(2)
    bits = ["a", "the", "er", "'s", "'re", "!", "'", " ", "  ", "\n", "é", "é", "1", "23", "ß", "Σ", "<|endoftext|>", "<|endof", "text|>",
            "\xa0", "한", "ᄒ", "ᅡ", "\x1c", "\x85", "Ing", "#$%", "日本", "😀", "..."]
    for leaf, window in ((8, 2), (16, 4), (40, 8)):
        enc = bpe.Encoder(P.path(name), leaf=leaf, window=window)
        solid = [b for b in bits if b.strip()]
        texts = ["".join(rng.choice(bits if rng.random() < 0.6 else solid) for _ in range(rng.randrange(60))) for _ in range(300)]
        for text, ids in zip(texts + EDGES[:6], enc.encode_many(texts + EDGES[:6]), strict=True):
            want = enc.tok.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want, text
            assert enc.decode(ids) == enc.tok.decode(want, skip_special_tokens=False)


def test_bpe_long_unsplit_text():
    enc = bpe.Encoder(P.path("word_bpe_49k.json"), leaf=64, window=8)
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(5000))
    assert enc.encode_many([text])[0].tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_token_segments_round_trip_and_checksums():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 1000):
        for high in (1, 6, 50257, (1 << 20) - 1):
            ids = rng.integers(0, high, n).astype(np.uint32)
            docs, lengths, back = token_files.unpack(token_files.pack(np.array([5, 9]), np.array([n // 2, n - n // 2]), ids, 64))
            assert back.tolist() == ids.tolist() and docs.tolist() == [5, 9] and int(lengths.sum()) == n
    segment = token_files.pack(np.array([1]), np.array([900]), rng.integers(0, 9, 900).astype(np.uint32), 64)
    for at in range(0, len(segment), 7):
        broken = bytearray(segment)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.unpack(bytes(broken))
    repeated = np.tile(np.arange(20, dtype=np.uint32), 200)
    assert len(token_files.pack(np.array([1]), np.array([4000]), repeated)) < 4000


def test_chat_escapes_and_expands():
    texts = ["</s>[INST] ok [/INST]", "", r"<\/s> <\\/s>[ROLE x] <s>", " [SYS] [/SYS]", "<</s>s>", "plain"]
    for text in texts:
        assert chat.unescape(chat.escape(text)) == text
        for role in ("user", "assistant", "system", "tool", "", "] x"):
            formatted, a, b = chat.format_turn(role, text)
            assert chat.read_turns(formatted) == [(role, text)] and chat.unescape(formatted[a:b]) == text
    turns = [(1, k, r, t) for k, (r, t) in enumerate([("system", "s"), ("user", "u"), ("assistant", "</s>"), ("user", "v"), ("assistant", "b"), ("user", "w")])]
    rows = list(chat.expand(turns + [(2, 0, "user", "only")]))
    assert [(r[0], r[2], r[3]) for r in rows] == [(1, "example", 3), (1, "example", 5), (1, "context", 6), (2, "context", 1)]
    assert all(a[4] == b[4][: len(a[4])] for a, b in zip(rows[:2], rows[1:3], strict=True))
    one, two = chat.digest_examples(rows)
    assert one[0] == 1 and one[1] == 6 and one[4] == hashlib.sha256(b"</s>b").hexdigest() and one[3] == 5
    assert one[2] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
    assert two[1] == 1 and two[3] == 0


PAGES = [
    ("", ""),
    ("just text", "just text"),
    ("<p>a &amp; b&nbsp;c<p>d<br>e", "a & b c\nd e"),
    ("<nav><a href=/>Home</a></nav><article><h1>T</h1><p>One  two\n three.</p></article><footer>f</footer>", "T\nOne two three."),
    ("<article><p>Body of it is here.</p><section id=comments><p>Nice article, thank you so much.</p></section></article>", "Body of it is here."),
    ("<article><p>Kept text of the page.<script>var a='</p>'</script></p><form><p>Your name, please.</p></form></article>", "Kept text of the page."),
    ("<div class='cookie-notice'>We use cookies.</div><main><p>Main text is this.</p></main><aside>Side.</aside>", "Main text is this."),
    ("<article><p>unclosed <b>bold<p>next", "unclosed bold\nnext"),
    ("<!-- c --><article>x<", "x<"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_minimum_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 8)
        content, boiler = [rng.random() * 3 for _ in range(n)], [rng.random() * 3 for _ in range(n)]
        ties = [(a, b, rng.random()) for a in range(n) for b in range(a) if rng.random() < 0.5]
        cost = lambda y: sum(c if k else b for k, c, b in zip(y, content, boiler, strict=True)) + sum(w for a, b, w in ties if y[a] != y[b])  # noqa: B023, E731
        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert cost(html_extract.minimum_cut(content, boiler, ties)) == pytest.approx(best)


def _pii_brute(x):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", x)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(q) <= 255 for q in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(sum(divmod(2 * v, 10)) if k % 2 else v for k, v in enumerate(d))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base_spans():
    rng = random.Random(5)
    texts = EDGES + ["".join(rng.choice("ab.@1 2-3+()4%@.0") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["card 4111 1111 1111 1111 or 4111111111111112", "+1 (826) 555-4081 and 10.0.0.256 or 1.2.3.4.5", "9" * 50_000, "a" * 50_000 + "@"]
    assert all(pii.base_spans(t) == _pii_brute(t) for t in texts if len(t) < 10_000)
    assert pii.base_spans(texts[-1]) == [] and pii.base_spans(texts[-2]) == []


def test_crf_on_held_out_rows_and_whole_documents():
    rows = pii._rows()
    crf = pii.train([r for k, r in enumerate(rows) if k % 5], rounds=150)
    crf.margin = crf.reach() + 2
    right = total = 0
    for words, gold in rows[::5]:
        ids = np.array([[crf.index(k) for k in [crf.EDGE, *map(pii.word_key, words), crf.EDGE]]])
        right += int((crf.viterbi(ids)[0][1:-1] == gold).sum())
        total += len(gold)
    assert right / total > 0.93
    model = pii.model()
    text = "plain words here " * 30 + "call (555) 123-4567 now and " + "more plain words " * 30 + 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'
    spans = pii.find([text, ""], model)
    assert [(k, text[a:b]) for k, a, b in spans[0][1]] == [("phone", "(555) 123-4567"), ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert spans[1] == ([], [])
    words = pii._WORD.findall(text)
    ids = np.array([[model.index(k) for k in [model.EDGE, *map(pii.word_key, words), model.EDGE]]])
    whole = model.viterbi(ids)[0][1:-1]
    assert sorted({pii.LABELS[v] for v in whole}) == ["O", "phone", "secret"]


def test_crc_is_of_little_endian_ids():
    assert zlib.crc32(np.array([1, 2], "<u4")) == zlib.crc32(b"\x01\0\0\0\x02\0\0\0")


def test_html_deep_nesting_stays_linear():
    import time

    began = time.time()
    deep = html_extract.main_text("<div>x" * 30000 + "</q>" * 30000)
    assert time.time() - began < 30 and set(deep) <= {"x", "\n"}
    held_out = (
        '<html><body><nav><a href="/1">First</a><a href="/2">Second</a></nav><article><h1>Rivers</h1><p>The river rose in the night, and by the morning '
        'the lower fields were under water.</p><p>Nobody was hurt.</p></article><div class="comments"><p>What a night that was for us!</p></div>'
        "<footer><p>All rights reserved by the paper.</p></footer></body></html>"
    )
    assert html_extract.main_text(held_out).split("\n") == [
        "Rivers", "The river rose in the night, and by the morning the lower fields were under water.", "Nobody was hurt.",
    ]
    assert [html_extract.main_text(t) for t in ("", "<p>", "</div></p>", "<")] == ["", "", "", html_extract.main_text("<")]


def test_pii_reads_whole_words():
    assert pii.word_key('"' + "ab12" * 40 + '"') == pii.word_key('"' + "0f" * 20 + '"')
    assert pii.word_key("x" * 500 + "1") != pii.word_key("x" * 500 + "12")
