import random

import public_tokenizers
from corpus import awkward_texts, clashing, empty, frame, rows, same
from tokenizers import Tokenizer

from sensorlake.llm.token_counts import PairMerger, merges_left, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_counts_match_the_library_on_awkward_strings():
    library, own = Tokenizer.from_file(PATH), PairMerger(PATH)
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", "Σ", "İ", *"aBzé É́ẛß\x1c\x85\xa0 ٣½😀‍你_-!09\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)] + ["lo" * 4000, "z" * 3001]
    texts += [t for t in awkward_texts() if t is not None]
    for t in texts:
        assert own.count(t) == len(library.encode(t, add_special_tokens=False).ids), t[:80]
    assert own.count(None) == 0


def test_merging_takes_the_lowest_rank_and_the_left_of_equal_pairs():
    # aaa with (a, a): one merge only; abab with (b, a) ranked before (a, b).
    assert merges_left([1, 1, 1], {1 << 32 | 1: 0}, [9]) == 2
    assert merges_left([1, 2, 1, 2], {2 << 32 | 1: 0, 1 << 32 | 2: 1}, [8, 9]) == 3


def test_frame(spark):
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t, *_ in rows():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    got = token_counts(clashing(frame(spark), "n_tokens", "n_bytes", "pad"), PATH)
    same(got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect(), want)
    assert token_counts(empty(spark), PATH).count() == 0
