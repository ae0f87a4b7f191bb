"""Training suggestions against a plain count."""

from collections import Counter

from conftest import rows
from hirelattice.operators import design


def test_trainings_are_counted_where_the_rows_of_a_set_lie(spark, monkeypatch):
    monkeypatch.setattr(design, "LISTED", 3)  # skill 1 has several lists
    missing = [(c, o, s) for c in range(4) for o in range(3) for s in range(1, 6) if (c + o + s) % 3]
    # repeated rows count twice, as does a training without an id
    taught = [(f, 1) for f in range(10)] + [(f, s) for f in range(5, 9) for s in range(2, 5)] + [(6, 2), (6, 2), (None, 3), (None, 3), (3, None)]
    got = design.suggest_training(spark.createDataFrame(missing, "id_candidat int, id_offre int, id_competence int"),
                                  spark.createDataFrame(taught, "id_formation int, id_competence int"), 2)
    # the opened lists are not dealt out again
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_key" in line and "id_formation" in line]
    want = []
    for pair in {m[:2] for m in missing}:
        counts = Counter(f for *p, s in missing if tuple(p) == pair for f, t in taught if t == s)
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0]))[:2]
        want += [(*pair, f, n, rank) for rank, (f, n) in enumerate(best, 1)]
    assert rows(got.select("id_candidat", "id_offre", "id_formation", "covered", "rank")) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
