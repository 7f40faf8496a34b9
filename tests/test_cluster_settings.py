"""The settings of the contract clusters share one fit of the components and one of the plot."""

from pyspark.sql import functions as F

from pactum.operators import features as Fe
from pactum.operators import models as M
from pactum.plans import modeling as P
from pactum.registry.common import described
from pactum.registry.model import CONTRACT_SETTINGS, q_contract_clusters

from conftest import SMOKE


def test_settings_share_the_fits_and_label_as_alone(spark, monkeypatch):
    fits, real = [], Fe.pca_fit
    monkeypatch.setattr(Fe, "pca_fit", lambda df, col, k: fits.append(k) or real(df, col, k))
    both = q_contract_clusters(spark, SMOKE)
    assert sorted(fits) == [2, 20]
    feats = P.prepare_contract_clusters(described(spark, SMOKE))
    cols = [c for c in feats.columns if c not in ("index", P.TARGET, "tfidf")]
    vec = M.assemble_features(feats, [*cols, "tfidf"], out="x").select("index", P.TARGET, "x")
    eps, n = CONTRACT_SETTINGS[1]
    alone = {r["index"]: r for r in P.contract_clusters(vec, "x", eps=eps, min_pts=n, n_pca=20).collect()}
    shared = both.where(F.col("setting") == f"{eps}/{n}").collect()
    assert both.count() == 2 * len(alone) == 2 * len(shared) > 0
    for r in shared:
        a = alone[r["index"]]
        assert (r["cluster"], r["is_core"], r[P.TARGET]) == (a["cluster"], a["is_core"], a[P.TARGET])
        assert abs(r["x_pca"] - a["x_pca"]) < 1e-9 and abs(r["y_pca"] - a["y_pca"]) < 1e-9
