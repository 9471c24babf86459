import random
from hashlib import sha256

import numpy as np
import tiktoken

from termloom.llm.bpe import Encoder, code_point_classes, encode_documents, read_ranks
from termloom.llm.queries import vocabulary_path


def reference():
    import public_tokenizers as P

    ranks = read_ranks(open(vocabulary_path(), "rb").read())
    return ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_match_the_library():
    ranks, want = reference()
    encoder = Encoder(ranks, code_point_classes())
    rng = random.Random(5)
    signs = ["'", "s", "re", "ll", "ve", " ", "  ", "\n", "　", "\t", "x", "Ü", "1", "²", "!", "é", "字", "\U0001f600", "\x1c", "\x85", "d", "t", "v", "e", "#"]
    texts = ["", "'", " 's", "''s", "'s's x", "'re'rx", " \n x", "  "] + ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(4000)]
    texts += ["".join(rng.choice("ab") for _ in range(4000)), "a" * 2000, " " * 3000]
    for text, (offsets, ids) in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()
        assert offsets[0] == 0 and offsets[-1] == len(text) and (np.diff(offsets) > 0).all()


def test_documents(spark, edge, empty):
    _, want = reference()
    got = encode_documents(edge, vocabulary_path()).collect()
    texts = edge.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    expect = sorted((str(r.doc_id), sha256(np.array(want.encode_ordinary(r.text or ""), "<u4").tobytes()).hexdigest(), sha256((r.text or "").encode()).hexdigest()) for r in texts)
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in got) == expect
    assert encode_documents(empty, vocabulary_path()).count() == 0
