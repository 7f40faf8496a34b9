"""The random search: concurrent fits, equal to a serial search, resumed from its ledger."""

import random

import pytest
from pyspark.ml.linalg import Vectors

from pactum.operators import models as M
from pactum.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(1)
    return spark.createDataFrame([(rnd.random(), Vectors.dense([rnd.random() for _ in range(4)])) for _ in range(300)],
                                 ["label", "features"]).repartition(3).cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_concurrent_equals_serial_and_overlaps(spark, frame):
    ledgers = [scratch_path(spark, "ledger") for _ in range(2)]
    one, many = (M.rf_random_search(frame, frame, "label", 4, seed=5, ledger=x, parallel=n) for x, n in zip(ledgers, (1, 4), strict=True))
    assert rows(one) == rows(many) and len(rows(one)) == 4

    def overlaps(path):
        spans = sorted((r["started"], r["finished"]) for r in M._finished_draws(spark, path, 5).values())
        return sum(b[0] < a[1] for a, b in zip(spans, spans[1:], strict=False))

    assert overlaps(ledgers[0]) == 0 and overlaps(ledgers[1]) >= 2


def test_a_restart_fits_what_is_missing(spark, frame, monkeypatch):
    ledger, fitted, real = scratch_path(spark, "ledger"), [], M.rf_fit_predict

    def watched(*a, **k):
        if len(fitted) == 2 and fitted[-1] != "dead":
            fitted.append("dead")
            raise RuntimeError("an executor is lost")
        fitted.append(k["trees"])
        return real(*a, **k)

    monkeypatch.setattr(M, "rf_fit_predict", watched)
    with pytest.raises(RuntimeError):
        M.rf_random_search(frame, frame, "label", 4, seed=6, ledger=ledger, parallel=1)
    assert sorted(M._finished_draws(spark, ledger, 6)) == [0, 1, 3]
    fitted[:] = ["dead"] * 3
    again = M.rf_random_search(frame, frame, "label", 4, seed=6, ledger=ledger, parallel=2)
    assert len(fitted) == 4 and len(rows(again)) == 4
    monkeypatch.setattr(M, "rf_fit_predict", real)
    assert rows(again) == rows(M.rf_random_search(frame, frame, "label", 4, seed=6, parallel=3))
    # Another seed shares no draw with this ledger.
    assert rows(M.rf_random_search(frame, frame, "label", 2, seed=7, ledger=ledger)) == rows(
        M.rf_random_search(frame, frame, "label", 2, seed=7))
