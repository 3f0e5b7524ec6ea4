"""Packing, token files and pieces against the libraries themselves."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import packing, pieces, token_files, tokens

WORDS = tokens.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
BYTES = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    "", " ", "  a  b\n\nc\t\td \r\n", "x<|endoftext|>y <|startoftext|>", "é 　x  y", "don't STOP!!\x1c go",
    "    def f(x):\n\t\treturn  x", "b" * 700 + " c", "中文字 😀é́ ​", " lead", "trail \n",
]


def texts(prose):
    rng = random.Random(3)
    mixed = ["".join(rng.choice(" ab\nthe1中 '") for _ in range(60)) for _ in range(200)]
    return ODD + mixed + [prose(300, n) for n in range(20)]


@pytest.mark.parametrize("vocabulary, leading_space", [(WORDS, False), (BYTES, True)])
def test_units_equal_whole_texts(prose, vocabulary, leading_space):
    whole = Tokenizer.from_str(vocabulary)
    whole.encode_special_tokens = True
    # A small cache is emptied again and again.
    for cache in (500_000, 50):
        encoder = tokens.UnitEncoder(vocabulary, leading_space, cache)
        for some in (texts(prose), texts(prose)[::-1]):
            for text, got in zip(some, encoder.encode(some)):
                want = whole.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(got, "<u4").tolist() == want, text


@pytest.mark.parametrize("vocabulary, leading_space", [(WORDS, False), (BYTES, True)])
def test_cuts_at_signs_equal_whole_texts(vocabulary, leading_space):
    """Letters beside signs, marks, digits and apostrophes; one becomes two when made small."""
    whole = Tokenizer.from_str(vocabulary)
    whole.encode_special_tokens = True
    forms = ["#", "a#", "#a", "#.", ".#", " #.", "#\n#", "#'s", "'#", "1#1", "#\u0301.", "(#\u0307)", "\n#", "# \n\n#"]
    some = [f.replace("#", chr(c)) for c in range(1, 0x250) for f in forms]
    rng = random.Random(9)
    parts = [*" \n'.,-<|>09absteSTRVE\u00e9\u00d7\u0130\u0301\u0307\u0338\u4e2d", "  ", "'re", "'LL", "<|endoftext|>", "J\u030c"]
    some += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5_000)]
    encoder = tokens.UnitEncoder(vocabulary, leading_space)
    want = whole.encode_batch(some, add_special_tokens=False)
    for text, got, ids in zip(some, encoder.encode(some), want):
        assert np.frombuffer(got, "<u4").tolist() == ids.ids, text


@pytest.mark.parametrize("vocabulary, leading_space", [(WORDS, False), (BYTES, True)])
def test_word_is_encoded_once_whatever_stands_beside_it(monkeypatch, vocabulary, leading_space):
    encoder = tokens.UnitEncoder(vocabulary, leading_space)
    sent = []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts, *more: sent.extend(texts) or ids(texts, *more))
    encoder.encode(["x zebrafish, zebrafish. y zebrafish!", "a zebrafish: zebrafish", "z zebrafish?! zebrafish;"])
    assert "".join(sent).count("zebrafish") == 1


@pytest.mark.parametrize("vocabulary, leading_space", [(WORDS, False), (BYTES, True)])
def test_slices_of_texts_keep_their_order(monkeypatch, vocabulary, leading_space):
    some = [*ODD, "", "\n", "a", "  "] * 3
    want = tokens.UnitEncoder(vocabulary, leading_space).encode(some)
    monkeypatch.setattr(tokens, "_SLICE_BYTES", 7)
    assert tokens.UnitEncoder(vocabulary, leading_space).encode(some) == want


def _placed(steps, histogram, capacity):
    bins, seen = defaultdict(dict), Counter()
    for length, first, n_bins, each, first_bin, offset in steps:
        assert seen[length] == first
        seen[length] += n_bins * each
        for k in range(n_bins * each):
            bins[first_bin + k // each][offset + k % each * length] = length
    assert seen == Counter(histogram)
    for held in bins.values():
        at = 0
        for offset in sorted(held):
            assert offset == at
            at += held[offset]
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    return bins


def _best_fit_decreasing(histogram, capacity):
    gaps = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [g for g in gaps if g >= length]
            if fitting:
                gaps.remove(min(fitting))
                gaps.append(min(fitting) - length)
            else:
                gaps.append(capacity - length)
    return len(gaps)


def test_plan_places_every_piece():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.randint(1, 60)
        histogram = {rng.randint(1, capacity): rng.randint(1, 25) for _ in range(rng.randint(0, 15))}
        bins = _placed(packing.plan(histogram, capacity), histogram, capacity)
        for held in bins.values():
            assert sum(3 * n > capacity for n in held.values()) <= 2
        assert len(bins) <= _best_fit_decreasing(histogram, capacity) + 1


def test_plan_is_bounded_and_tight():
    rng = np.random.default_rng(0)
    histogram = Counter(np.minimum(2048, rng.lognormal(6.8, 0.9, 100_000).astype(int) + 1).tolist())
    steps = packing.plan(histogram)
    bins = _placed(steps, histogram, 2048)
    assert len(bins) < 1.01 * sum(n * c for n, c in histogram.items()) / 2048
    larger = packing.plan({n: 1000 * c for n, c in histogram.items()})
    assert len(larger) < 1.2 * len(steps)
    with pytest.raises(ValueError):
        packing.plan({2049: 1})


def test_packed_documents(spark, prose, docs_of):
    # One length that most pieces share, and repeated rows.
    some = texts(prose) + ["same words here"] * 400 + [prose(3_000, 7)]
    whole = Tokenizer.from_str(WORDS)
    whole.encode_special_tokens = True
    rows = packing.pack_documents(docs_of(some), WORDS, capacity=256).collect()
    want = Counter()
    for n, text in enumerate(some):
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 256)):
            cut = ids[at : at + 256]
            want[n, piece, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256


def test_files_round_trip(spark, prose, docs_of, tmp_path):
    some = texts(prose)
    whole = Tokenizer.from_str(BYTES)
    whole.encode_special_tokens = True
    all_ids = [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in some]
    manifest = token_files.write(docs_of(some).repartition(5), f"file://{tmp_path}/tokens", BYTES, 50_257, length=64, batch=3)
    got = {r["doc_id"]: r for r in token_files.read(manifest).collect()}
    start = 0
    for n, ids in enumerate(all_ids):
        assert (got[n]["start"], got[n]["n_tokens"]) == (start, len(ids))
        assert got[n]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # Sequences and masks by themselves, in order of the files.
    held = []
    for row in sorted(manifest.collect(), key=lambda r: r["part"]):
        sequences = token_files.SequenceFile(row["path"] + ".arrow")
        for n in range(len(sequences)):
            ids, mask = sequences.ids(n), sequences.mask(n).to_numpy(zero_copy_only=False)
            assert ids.dtype == np.uint16 and len(ids) == len(mask) == 64
            assert not ids.flags.owndata  # a view of the mapped file
            held.extend(ids[mask].tolist())
            assert n == len(sequences) - 1 or mask.all()
        sequences.close()
    assert held == [n for ids in all_ids for n in ids]


def test_pieces_equal_the_library(prose):
    model, library = pieces.PieceModel(MODEL, cache_words=300), sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    some = [*texts(prose), "<s> <0x0A> ▁▁a", "▁"]
    for _ in range(2):
        for text, got in zip(some, model.encode(some)):
            ids = np.frombuffer(got, "<u4").tolist()
            assert ids == library.encode(text)
            assert model.decode(ids) == text.replace("▁", " ")


def test_unigram_by_brute_force():
    """The additive states: the best of all segmentations."""
    rng = random.Random(2)
    for _ in range(60):
        scores = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): -rng.random() * 5 for _ in range(8)}
        segmenter = pieces.Segmenter(scores, merges=False, unknown=-20.0)

        def best(word):
            if not word:
                return 0.0
            cuts = ((scores.get(word[:n], -20.0 if n == 1 else None), word[n:]) for n in range(1, min(4, len(word)) + 1))
            return max(s + best(rest) for s, rest in cuts if s is not None)

        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(20)]
        for word, found in segmenter.segment(words):
            assert "".join(found) == word
            assert sum(scores.get(p, -20.0) for p in found) == pytest.approx(best(word))


def test_pieces_query_decodes(spark, prose, docs_of):
    some = texts(prose)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(docs_of(some), MODEL), MODEL).collect()}
    assert [back[n] for n in range(len(some))] == some
