"""Token counts against the library; packing against one-at-a-time best fit."""

import random
import struct
import time
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from alarmloom.llm import packing
from alarmloom.llm.token_counts import PieceCounter, merged_count, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


def test_counts_equal_library(spark, edge_docs, edge_rows, library):
    got = sorted(map(repr, (tuple(r) for r in token_counts(edge_docs, PIECES).collect())))
    want = []
    for doc_id, text, *_ in edge_rows:
        n = len(library.encode(text or ""))
        want.append(repr((doc_id, len((text or "").encode()), n, n > 4096)))
    assert got == sorted(want)


def test_random_strings_equal_library(library):
    rng = random.Random(3)
    alphabet = " \n\t▁abtheinrABéßñ漢字😀<s>/\u0000　ﬁ０'0123"
    count = PieceCounter(PIECES).count
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert count(text) == len(library.encode(text)), repr(text)


def test_lowest_rank_merges_first():
    ranks = {"a": 9, "b": 9, "c": 9, "ab": 2, "bc": 1, "abc": 3}
    assert merged_count("abc", ranks) == 1  # bc, then a + bc
    assert merged_count("aba", ranks) == 2
    assert merged_count("xé", ranks) == 3  # no pieces: one symbol a byte


def test_counts_of_nothing_and_clashing_names(no_docs, clashing, edge_docs):
    assert token_counts(no_docs, PIECES).count() == 0
    assert sorted(token_counts(clashing, PIECES).collect(), key=str) == sorted(
        token_counts(edge_docs, PIECES).collect(), key=str
    )


def best_fit_decreasing(lengths, capacity):
    """Sequences opened when pieces are placed one at a time."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, opened = capacity, opened + 1
        insort(gaps, gap - length)
    return opened


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 400))]
    if seed % 3 == 0:
        lengths = [rng.choice([1, 2, 3, capacity // 2]) for _ in lengths]
    counts = Counter(lengths)
    rows = packing.plan(counts, capacity)
    used, held = defaultdict(int), defaultdict(list)
    by_length = defaultdict(list)
    for length, *run in rows:
        by_length[length].append(run)
    for length, n in counts.items():
        for rank in range(n):
            first, sequence, slots, at = [r for r in by_length[length] if r[0] <= rank][-1]
            place = rank - first
            held[sequence + place // slots].append((at + place % slots * length, length))
            used[sequence + place // slots] += length
    for parts in held.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(x[1] for x in parts[:i]) for i in range(len(parts))]
    assert max(used.values()) <= capacity
    assert len(held) == best_fit_decreasing(lengths, capacity)


def test_plan_stays_small_whatever_the_counts():
    counts = {length: 10**9 + length * 7919 for length in range(1, 2049)}
    assert len(packing.plan(counts, 2048)) < 11 * 3 * 2048


def test_packing_of_documents(edge_docs, edge_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = packing.best_fit_packing(edge_docs, WORDS, 512).collect()
    want = Counter()
    for doc_id, text, *_ in edge_rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            want[doc_id, piece, at, len(part), crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        ends = [offset + length for offset, length in parts]
        assert [0, *ends[:-1]] == [offset for offset, _ in parts]
        assert ends[-1] <= 512
    assert len(sequences) == best_fit_decreasing([r.length for r in got], 512)


def test_many_chunks_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_CHUNK", 10)
    docs = spark.createDataFrame([(i, "same text") for i in range(500)], "doc_id long, text string")
    got = packing.best_fit_packing(docs, WORDS, 16).collect()
    places = Counter((r.sequence_id, r.offset) for r in got)
    assert len(got) == 500 and max(places.values()) == 1
    assert len({r.sequence_id for r in got}) == -(-500 // (16 // got[0].length))


def test_packing_of_nothing(no_docs):
    assert packing.best_fit_packing(no_docs, WORDS).count() == 0


def test_word_ids_equal_library(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    monkeypatch.setattr(packing, "KEPT_WORDS", 50)
    words = packing.WordIds(WORDS)
    rng = random.Random(6)
    alphabet = " \n\tabtheINRÀéßñŁž.,!'s't're12$#<|endoftext|>ı"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["it's <|endoftext|> here", "<|ENDOFTEXT|> x", "<|startoftext|>", "İstanbul", "é"]
    for at in range(0, len(texts), 40):
        for text, ids in zip(texts[at : at + 40], words.ids_of(texts[at : at + 40])):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids == b"".join(i.to_bytes(4, "little") for i in want), repr(text)


def test_parts_merged_in_arrays_are_those_of_the_library():
    """Odd signs, long runs and parts beyond the arrays' width, batch after batch."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), packing.WordIds(path)
    rng = random.Random(2)
    signs = [*map(chr, range(32, 0x180)), *" \t\n\r'stredvm", "<|", "日", "*" * 40]
    for _ in range(4):
        texts = [
            "".join(rng.choices(rng.choice([signs, "abcdeinth' *#é1"]), k=rng.randrange(120)))
            for _ in range(200)
        ]
        for text, ids in zip(texts, words.ids_of(texts)):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids == struct.pack(f"<{len(want)}I", *want)


def invented(seed, words):
    """A text of new words beside common ones, with case, marks and numbers."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfglmnprst" for b in ("a", "en", "io", "é", "our", "ly")]
    common = ["".join(rng.choices(syllables, k=2)) for _ in range(100)]
    new = ("".join(rng.choices(syllables, k=rng.randrange(2, 5))) for _ in range(words))
    marks = ["", "", "", "", ",", ".", "'s", "!!", " 42", "\n"]
    return " ".join(
        (rng.choice(common) if rng.random() < 0.6 else word.capitalize()) + rng.choice(marks)
        for word in new
    )


def test_words_take_a_fraction_of_the_library_s_seconds():
    """Of CPU; word by word in Python it was about half of them."""
    from tokenizers import Tokenizer

    library, words = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    texts = [invented(seed, 400) for seed in range(1000)]
    began = time.process_time()
    got = list(words.ids_of(texts))
    middle = time.process_time()
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    ended = time.process_time()
    assert got == [struct.pack(f"<{len(ids)}I", *ids) for ids in want]
    assert middle - began < 0.4 * (ended - middle)


def test_only_words_of_other_characters_go_to_the_library():
    words, asked = packing.WordIds(WORDS), []
    library = words.tokenizer

    class Asked:
        def encode(self, sequence, **how):
            asked.extend([sequence] if isinstance(sequence, str) else sequence)
            return library.encode(sequence, **how)

    words.tokenizer = Asked()
    texts = ["Plain words, don't ask. " * 200 + "it’s “so”\u00a0日本 it’s <|endoftext|>", "é 日本"]
    got = list(words.ids_of(texts))
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert got == [struct.pack(f"<{len(ids)}I", *ids) for ids in want]
    assert sorted(asked) == sorted(["it’s", "“so”\u00a0日本", "<|endoftext|>", "日本"])


def test_what_is_kept_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 1000)
    words = packing.WordIds(WORDS)
    for seed in range(20):
        list(words.ids_of([invented(seed, 3000), "x" * 100]))
        kept = words.known.to_pylist()
        assert len(kept) == len(words.known_ids) <= 1000
        assert max(map(len, kept)) <= packing.KEPT_LENGTH
