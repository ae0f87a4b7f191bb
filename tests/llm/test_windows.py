"""Windows of texts held against a benchmark."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from hirelattice.llm import decontaminate
from hirelattice.llm.words import words_of


def test_windows_near_an_item_are_those_of_a_plain_cosine():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(30)) + "." for _ in range(6)]
    items = decontaminate.read_items(list(enumerate(texts)))
    vocabulary = decontaminate.Vocabulary(items)
    idf = np.linspace(1.0, 2.0, len(vocabulary.words))
    space = np.eye(len(vocabulary.words), dtype=np.float32)
    index = decontaminate.Index(items, vocabulary, idf, space)
    documents = [" ".join(["zz9"] * rng.randint(0, 50) + texts[rng.randint(0, 5)].split()[rng.randint(0, 12):] + ["q"] * rng.randint(0, 9)) for _ in range(40)] + ["", "aa bb"]
    asked: list = []
    index._confirmed = lambda item, words, text, low: asked.append((text, item.id, low - int(words.first[text]))) or False
    for words in words_of(pa.array(documents, pa.string())):
        list(index.leaks(words))
    weight = dict(zip(vocabulary.words.tolist(), idf))
    other = float(np.median(idf))
    want = []
    for words in words_of(pa.array(documents, pa.string())):
        for t, (low, high) in enumerate(zip(words.first[:-1], words.first[1:])):
            for at in range(low, high, decontaminate.STEP):
                window = words.hash[at:min(high, at + decontaminate.WINDOW)].tolist()
                for item in items:
                    row = {w: item.words.tolist().count(w) * weight[w] for w in set(item.words.tolist())}
                    dot = sum(weight.get(w, 0) * row.get(w, 0) for w in window)
                    norm = np.sqrt(sum((window.count(w) * weight.get(w, other)) ** 2 for w in set(window)))
                    if dot / norm / np.sqrt(sum(v * v for v in row.values())) >= decontaminate.NEAR:
                        want.append((t, item.id, at - int(low)))
    assert sorted(asked) == sorted(want) and want
