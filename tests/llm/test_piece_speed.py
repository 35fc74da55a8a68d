"""SentencePiece encoding: one search a word where longest matches stand, and the same pieces as by merging."""

import random

import public_tokenizers

from tidemark.llm import piece_bpe


class Counted:
    def __init__(self, automaton):
        self.automaton, self.n = automaton, 0

    def iter_long(self, s):
        self.n += 1
        return self.automaton.iter_long(s)


def by_merging(p, s):
    parts = list(s)
    while True:
        found = [(p.cost[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in p.cost]
        if not found:
            return parts
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_one_search_and_the_pieces_of_merging():
    p = piece_bpe.Pieces(piece_bpe.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    some = random.Random(3)
    words = ["▁" + "".join(some.choices("abeinorstu", k=some.randint(1, 14))) for _ in range(2000)] + ["▁thesis", "▁unbelievable", "▁aaaaaaaaaaaaaaaa", "▁", "▁▁▁a"]
    p.automaton = Counted(p.automaton)
    greedy = 0
    for w in words:
        before = p.automaton.n
        ids = p.backtrack(w)
        assert [p.pieces[i] for i in ids] == by_merging(p, w) == p.merged(w)
        greedy += p.automaton.n - before == 1 < len(ids)
    assert greedy > len(words) // 4
    for a, b in [("▁th", "e"), ("▁", "a"), ("on", "s"), ("e", "r")]:
        x, y = p.ids[a], p.ids[b]
        assert p.together(x << 32 | y) == (by_merging(p, a + b) == [a, b])
