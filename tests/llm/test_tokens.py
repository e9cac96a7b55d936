"""Token memories, prefix BPE, packing, Huffman coding and separator scans against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailspark.llm import huffman, packing, pieces, prefix_bpe, separators
from tests.conftest import SMALL

ODD = [
    "", " ", "\n", "a", " a", "a ", "a\nb", "a\n\nb", "a \n b", "a  b", "\ta\x0bb\x1cc", "<|endoftext|>", "x <|endoftext|>y z",
    "It's we'll THEY'RE", "école Straße İstanbul ΣΑΣ", "日本語 🎉🎉 text", "a b  c", "a" * 300 + " " + "#" * 300,
    "1234 a1b2 ...", "\x00 \x02 x", "é ́x",
]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()] + ODD


def library(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(pieces.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(name, texts):
    return [e.ids for e in library(name).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("kind, name", [
    (pieces.ByteBpe, "byte_bpe_50k.json"), (pieces.WordBpe, "word_bpe_49k.json"), (prefix_bpe.PrefixBpe, "byte_bpe_50k.json"),
])
def test_memories_give_the_librarys_ids(texts, kind, name):
    memory = kind(pieces.path(name), limit=500)  # so that it is emptied on the way
    got = [x for i in range(0, len(texts), 50) for x in memory.encode(texts[i : i + 50])]
    assert got == [memory.pack(x) for x in ids_of(name, texts)]


@pytest.mark.parametrize("kind, name", [(pieces.ByteBpe, "byte_bpe_50k.json"), (pieces.WordBpe, "word_bpe_49k.json")])
def test_a_large_vocabulary_is_encoded_once(kind, name, monkeypatch):
    memory, encoded = kind(pieces.path(name)), []
    monkeypatch.setattr(memory, "_pieces", lambda wanted: [encoded.append(p) or p.encode() for p in wanted])
    texts = [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(0, 600_000, 1000)]
    for _ in range(2):
        for text in texts:
            assert memory.encode([text])[0].endswith(text[text.index(" ") :].replace(" ", "").encode())
    assert len(encoded) == len(set(encoded)) == 599_400  # the first word of a text follows no space


def test_a_word_is_encoded_once_in_any_case_and_with_any_sign(monkeypatch):
    memory = pieces.WordBpe(pieces.path("word_bpe_49k.json"))
    text = "x Überall überall, ÜBERALL! mot Mot. mot?\nMot: mOt;\nüberall"
    whole, encoded, ids = memory._whole([text]), [], memory._ids
    monkeypatch.setattr(memory, "_ids", lambda texts: encoded.extend(w for t in texts for w in t.split()) or ids(texts))
    assert memory.encode([text]) == whole == memory.encode([text])
    assert sorted(w for w in encoded if w != "x") == ["mot", "überall"]


def test_sentence_pieces_give_the_librarys_ids(texts):
    memory = separators.SentencePieces(pieces.path("piece_bpe_32k.model"))
    assert memory.encode(texts) == [memory.pack(x) for x in memory.model.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeét 'sS1#\n.", max_size=60))
def test_prefix_bpe_is_exact(text):
    memory = pieces.held(prefix_bpe.PrefixBpe, pieces.path("byte_bpe_50k.json"))
    whole = pieces.held(pieces.ByteBpe, pieces.path("byte_bpe_50k.json"))
    got = memory.encode([text])[0]
    assert got == whole._whole([text])[0]
    assert memory.decode(np.frombuffer(got, "<u2")) == text


def test_round_trip_on_spark(spark, texts):
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    rows = {r.doc_id: r for r in prefix_bpe.round_trip(docs).collect()}
    decoded = {r.doc_id: r for r in prefix_bpe.decode(prefix_bpe.encode(docs)).collect()}
    for i, (text, ids) in enumerate(zip(texts, ids_of("byte_bpe_50k.json", texts))):
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids
        assert rows[i].text == decoded[i].text == text
    assert (rows[len(texts)].ids, rows[len(texts)].text) == (b"", "")


# ------------------------------------------------------------------ packing


def check_plan(histogram, capacity):
    uses, windows = packing.plan(histogram, capacity)
    filled = {}
    for length, count in histogram.items():
        for rank in range(count):
            parts = list(packing.places(uses, length, rank))
            assert sum(n for n, _, _ in parts) == length
            for n, window, offset in parts:
                filled.setdefault(window, []).append((offset, n))
    assert sorted(filled) == list(range(windows))
    for window, parts in filled.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == capacity if window < windows - 1 else end <= capacity
    return windows


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 15), st.integers(0, 30), max_size=15))
def test_plans_fill_every_window_but_the_last(histogram):
    total = sum(n * c for n, c in histogram.items())
    assert check_plan(histogram, 16) == -(-total // 16)


def test_a_filling_comes_nearest_to_the_capacity():
    classes = {n: packing.Class(n, c) for n, c in {9: 1, 7: 2, 5: 1, 4: 1}.items()}
    assert packing.fill(classes, 16) == {9: 1, 7: 1}
    classes = {n: packing.Class(n, c) for n, c in {9: 1, 5: 2}.items()}
    assert packing.fill(classes, 16) == {9: 1, 5: 1}


def test_packs_hold_every_id_once(spark, texts):
    docs = spark.createDataFrame([*enumerate(texts), (7000, None), (3, texts[3])], "doc_id long, text string")
    rows = packing.pack(docs, with_ids=True).collect()
    want = {i: [*x, 0] for i, x in enumerate(ids_of("byte_bpe_50k.json", texts))} | {7000: [0]}
    seen, windows = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert ids.tolist() == want[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(want[r.doc_id])
        assert zlib.crc32(ids.astype("<u4")) == r.ids_crc32
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, ids in want.items():
        assert sum(n for _, n in seen[doc_id]) == len(ids) * (2 if doc_id == 3 else 1)
    for parts in windows.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), [*sorted(parts)[1:], (sum(n for _, n in parts), 0)]))
    total = sum(r.length for r in rows)
    assert sorted(windows) == list(range(-(-total // 1024)))


# ------------------------------------------------------------------ Huffman


@pytest.mark.parametrize("n, total", [(1, 3), (2, 9), (300, 5000), (49_408, 200_000)])
def test_codes_are_complete_and_decode(n, total):
    ids = (np.random.default_rng(n).zipf(1.3, total) % n).astype(np.uint16)
    counts = np.bincount(ids, minlength=n)
    lengths = huffman.code_lengths(counts)
    used = lengths[lengths > 0]
    assert used.max() <= huffman.LONGEST and (len(used) == 1 or (2.0**-used).sum() == 1)
    share = counts[counts > 0] / total
    assert (lengths * counts).sum() / total <= max(1.0, -(share * np.log2(share)).sum() + 1)
    codes = huffman.canonical(lengths)
    bits, checkpoints = huffman.encode_bits(ids, codes, lengths)
    decoder = huffman.Decoder(codes, lengths)
    assert (decoder.decode(bits, checkpoints, total) == ids).all()
    if len(checkpoints) > 2:  # one block alone
        part = decoder.decode(bits, checkpoints[1:2], huffman.BLOCK)
        assert (part == ids[huffman.BLOCK : 2 * huffman.BLOCK]).all()


def test_short_limits_hold():
    counts = np.array([1 << i for i in range(30)])
    lengths = huffman.code_lengths(counts, 6)
    assert lengths.max() == 6 and (2.0**-lengths).sum() == 1


def test_files_give_back_all_ids(spark, texts, tmp_path):
    docs = spark.createDataFrame([(9 - i, t) for i, t in enumerate(texts)] + [(500, None), (500, None)], "doc_id long, text string")
    huffman.write(docs, str(tmp_path / "coded"))
    rows = sorted(huffman.read(spark, str(tmp_path / "coded")).collect(), key=lambda r: r.start)
    want = sorted([(9 - i, [*x, 1]) for i, x in enumerate(ids_of("word_bpe_49k.json", texts))]) + [(500, [1])] * 2
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    start = 0
    for r, (_, ids) in zip(rows, want):
        assert r.start == start and np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)


# --------------------------------------------------------------- separators


@pytest.mark.parametrize("width", [2, 4])
def test_scans_stitch_blocks(spark, tmp_path, width):
    rng, want = random.Random(width), {}
    (tmp_path / "flat").mkdir()
    for f in range(6):
        ids = [rng.choice([2, 2, 5, 700]) for _ in range(rng.choice([0, 1, 50, 400]))]
        ids = [5] * 60 if f == 4 else [2] * 7 if f == 5 else ids
        (tmp_path / "flat" / f"f{f}").write_bytes(np.array(ids, f"<u{width}").tobytes())
        start = 0
        for n, end in enumerate([*(i for i, x in enumerate(ids) if x == 2), len(ids)]):
            if end < len(ids) or end > start:
                want[f"f{f}", n] = (start, end - start, end < len(ids))
            start = end + 1
    found = separators.scan(separators.blocks(spark, str(tmp_path / "flat"), width, 8 * width), 2, width)
    assert {(r.file, r.ordinal): (r.start, r.n_tokens, r.closed) for r in found.collect()} == want


def test_files_of_another_width_fail(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        separators.scan(separators.blocks(spark, str(tmp_path))).collect()


def test_written_files_are_flat(spark, texts, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    separators.write_flat(docs, str(tmp_path / "flat"))
    (file,) = (tmp_path / "flat").glob("part-*")
    memory = separators.SentencePieces(pieces.path("piece_bpe_32k.model"))
    assert file.read_bytes() == b"".join(x + b"\x02\x00" for x in memory.encode(texts))
