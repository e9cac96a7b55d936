"""Words that go to the tokenizer's model alone, against the library, and coding by one look-up an id."""

import random
import string

import numpy as np

from retailspark.llm import huffman, pieces

FILE = "word_bpe_49k.json"


def test_a_word_is_encoded_once_whatever_signs_stand_behind_it(monkeypatch):
    memory = pieces.WordBpe(pieces.path(FILE))
    text = "x mot mot&&& Mot,*** MOT?!\nmot###"
    whole, encoded, ids = memory._whole([text]), [], memory._ids
    monkeypatch.setattr(memory, "_ids", lambda texts: encoded.extend(w for t in texts for w in t.split()) or ids(texts))
    assert memory.encode([text]) == whole == memory.encode([text])
    assert [w for w in encoded if any(c.isalpha() for c in w) and w != "x"] == ["mot"]


def test_letters_and_signs_of_all_kinds_give_the_librarys_ids():
    from tokenizers import Tokenizer

    library, memory, rng = Tokenizer.from_file(pieces.path(FILE)), pieces.WordBpe(pieces.path(FILE)), random.Random(1)
    library.no_truncation()
    library.no_padding()
    letters = [c for c in map(chr, range(256)) if c.isalpha()]
    whole = ["<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>", "it's", "IT'S", "'s", "ΣΑΣ", "İx", "é", "ẞ"]
    texts = []
    for _ in range(2_000):
        words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 20))]
        words = [w + "".join(rng.choices(string.punctuation, k=rng.randint(0, 3))) for w in words]
        texts.append(" ".join(rng.choice(whole) if rng.random() < 0.05 else w for w in words).replace(" A", "\nA"))
    found = [memory.encode(texts[at : at + 100]) for at in range(0, len(texts), 100)]
    assert sum(found, []) == [memory.pack(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_size_is_coded_and_read_back():
    rng = np.random.default_rng(1)
    for n in (1, 2, 255, 256, 257, 5_000):
        ids = (rng.pareto(0.3, n) % 60_000).astype("<u2")
        lengths = huffman.code_lengths(np.bincount(ids, minlength=60_000))
        codes = huffman.canonical(lengths)
        bits, checkpoints = huffman.encode_bits(ids, codes, lengths)
        text = "".join(f"{codes[i]:0{lengths[i]}b}" for i in ids.tolist())
        assert bits == int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")
        decoder = huffman.Decoder(codes, lengths)
        assert decoder.decode(bits, checkpoints, n).tolist() == ids.tolist()
        assert decoder.entries.nbytes == 4 << huffman.LONGEST  # one number a code's look-up
