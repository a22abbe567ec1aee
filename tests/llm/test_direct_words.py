"""Words of ASCII letters go to the first tokenizer's model at once: the ids are those of the whole tokenizer."""

import numpy as np

from tributary.llm.alignment import load
from tributary.llm.queries import tokenizer

TEXTS = ["plain words Here", "it's don't I'll A'S", "'s t re", " lead", "trail ", "a  b", "a\nb\n c", "\t x y", "ab1 c2d", "<|endoftext|> end", "é è ü", "x　y  z", "ſ K"]


def test_ids_are_those_of_the_whole_tokenizer():
    both = load(tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    both.kept.clear()
    assert both.direct
    asked, whole = [], both.a

    class Counting:
        model = whole.model

        def encode_batch_fast(self, units, **options):
            asked.extend(units)
            return whole.encode_batch_fast(units, **options)

    both.a = Counting()
    try:
        spaced = [" " + t for t in TEXTS]
        found = both._ids_a(spaced)
    finally:
        both.a = whole
        both.kept.clear()
    assert [f.tolist() for f in found] == [e.ids for e in whole.encode_batch_fast(spaced, add_special_tokens=False)]
    assert all(f.dtype == np.int64 for f in found)
    assert " plain" not in asked and " Here" not in asked and " ab1" in asked
