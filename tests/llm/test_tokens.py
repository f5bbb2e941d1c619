"""Token ids against the tokenizer file itself, and the bounded merge of open windows."""

import random
from collections import defaultdict

import numpy as np
import pandas as pd

from lifeloom.llm.packing import leftovers, merged
from lifeloom.llm.tokens import TokenBytes


def test_added_tokens_are_read_as_the_tokenizer_file_says():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(3)
    pieces = [*" \n\t  ab'sé9.!?\r\x0b 字<|", "<|endoftext|>", " <|endoftext|> ", "a<|endoftext|>"]
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        for file in (None, path):
            for tokenizer in (whole, plain):
                encode = TokenBytes.load(file, tokenizer is plain)
                assert np.frombuffer(encode(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_windows_left_open_are_merged_in_bounded_groups(spark):
    """Only so many windows go on from a group, and every piece still has a place of its own."""
    rng = random.Random(6)
    used = pd.DataFrame({"window": range(300), "used": [rng.randint(1, 100) for _ in range(300)]})
    done = merged(used, 128, 10)
    assert done[done["open"]]["into"].nunique() == 10 and len(done) == 300
    rows = [((part << 32) + i, rng.randint(1, 120)) for part in range(70) for i in range(5)]
    places = leftovers(spark.createDataFrame(rows, "window long, used long"), 70, 128, 5).collect()
    length, taken = dict(rows), defaultdict(list)
    for r in places:
        taken[r.sequence_id].append((r.base, r.base + length[r.window]))
    assert len(places) == len(rows) and len(taken) < len(rows)
    for spans in taken.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 128 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
