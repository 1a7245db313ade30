import random

import numpy as np
import public_tokenizers
from hirelens.llm import token_ids
from tokenizers import Tokenizer

WORDS = token_ids.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
ODD = [None, "", " ", "a\x01b", "I'll  it's <|endoftext|> x", "don't </w> w </w>", "\x85 x\xa0y z　"]
ODD += ["İstanbul ΣΑΣ é ́x a ̈b", "x\x1cy", "ª²½ ß", "ÅB"]


def test_like_the_library(some):
    rng = random.Random(3)
    pick = lambda: chr(rng.choice([rng.randrange(127), rng.randrange(0x80, 0x3100), rng.randrange(0x10000, 0x11000), 32, 97, 39]))
    texts = ODD + ["".join(pick() for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += [r["text"] for r in some.collect()]
    library = Tokenizer.from_str(WORDS)
    for encoder in (token_ids.Encoder(WORDS), token_ids.Encoder(WORDS)):
        encoder.chunks.limit = encoder.pieces.limit = 300  # forgets between blocks
        for start in range(0, len(texts), 400):
            part = texts[start : start + 400]
            for t, ids in zip(part, encoder.encode(part)):
                want = library.encode(t, add_special_tokens=False).ids if t else []
                assert np.frombuffer(ids, "<u4").tolist() == want
