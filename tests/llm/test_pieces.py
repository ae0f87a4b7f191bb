"""Pieces of texts and their ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from hirelattice.llm import tokens


def test_pieces_have_the_ids_of_the_whole_text(monkeypatch):
    import public_tokenizers
    import tokenizers

    monkeypatch.setattr(tokens, "KEPT", 500)
    white = [" ", "  ", "\t", "\n", "\r\n", "\u00a0", "\u2003", "\u3000", "\x85", "\x1c", ""]
    bits = ["foo", "été", "Ö", "straße", "x×y", "a÷b", "...", ",", "?!", "»", "—", "”", "€", "日本", "привет", "🙂", "12", "don't", "foo.bar", "A.B.", "œuvre", "<|endoftext|>", "_"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(bits) + rng.choice(white) * rng.randint(0, 2) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    texts = pa.array([None, "", " ", *texts, "a "], pa.string()).slice(1)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
        encoder, ids, counts = tokens.Encoder(whole), [], []
        for low, high in tokens.column_runs(texts, 4000):
            some, n = encoder.encode(texts.slice(low, high - low))
            ids += some.tolist()
            counts += n.tolist()
        assert counts == [len(w) for w in want]
        assert ids == [i for w in want for i in w]


def test_pieces_begin_before_white_space_and_at_marks():
    text = "Été, oui.  non\u00a0 a1,b"
    data = np.frombuffer(text.encode(), np.uint8)
    at = [0, *tokens.piece_starts(data, np.array([0, len(data)]))[1:], len(data)]
    pieces = [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]
    assert pieces == ["Été", ",", " oui", ".", "  non\u00a0 a1,b"]
