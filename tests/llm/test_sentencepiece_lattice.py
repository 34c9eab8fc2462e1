import random

import sentencepiece
from revstrata.llm import sentencepiece_lattice as L

LIB = sentencepiece.SentencePieceProcessor(model_file=L.MODEL)


def test_fold_against_the_library():
    pieces, rnd = L.load_pieces(), random.Random(1)
    for _ in range(2000):
        t = "".join(rnd.choice("abthe noniné😀x\n \t漢字<s>▁12.,²_-") for _ in range(rnd.randint(0, 120)))
        ids = [i for u in L.units_of(t, pieces) for i in L.fold_unit(u, pieces)] if t else []
        assert ids == LIB.encode(t), t
        coarse = L.words_of(t) if t else []
        assert [i for w in coarse for i in L.fold_unit(w, pieces)] == ids and "".join(coarse) == (L.MARK + t.replace(" ", L.MARK) if t else "")
    assert pieces.fine and not L.Pieces([], {"a1": (0.0, 0)}, 0, 2).fine


def test_lattice_is_the_fold(spark):
    pieces = L.load_pieces()
    units = ["▁the", "▁nonthing", "▁▁▁▁▁", "▁é😀", "\n\n", "漢字", "▁aaaaaaa", "x", "▁unbelievable", "inging", "banana"]
    got = {r.unit: list(r.ids) for r in L.lattice(spark.createDataFrame([(u,) for u in [*units, ""]], "unit string"), pieces).collect()}
    assert got == {u: L.fold_unit(u, pieces) for u in units}


def test_documents(odd, none):
    for size in (0, 50):
        got = L.decode(L.encode(odd, size=size)).collect()
        assert len(got) == odd.count()
        for r in got:
            assert list(r.ids) == LIB.encode(r.text or "") and r.lossless and r.decoded == (r.text or "") and r.n_pieces == len(r.ids) and r.score == "mine"
    assert L.encode(none).isEmpty()


def test_viterbi_against_a_loop(spark):
    rnd = random.Random(2)
    table = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))): -rnd.randint(1, 64) / 8 for _ in range(30)}
    units = ["", *{"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 14))) for _ in range(40)}]

    def best(unit):
        state = [(0.0, [])]
        for e in range(1, len(unit) + 1):
            ways = []
            for b in range(max(0, e - 4), e):
                score = table.get(unit[b:e], -20.0 if e == b + 1 else None)
                if score is not None:
                    ways.append((state[b][0] + score, -b, [*state[b][1], unit[b:e]]))
            top = max(ways, key=lambda w: w[:2])
            state.append((top[0], top[2]))
        return state[-1]

    rows = L.best_paths(spark.createDataFrame([(u,) for u in units], "unit string"), spark.createDataFrame(list(table.items()), "piece string, score double"), 4).collect()
    assert {r.unit: (r.score, list(r.pieces)) for r in rows} == {u: best(u) for u in units}
