import pytest
from pyspark.sql import functions as F

from gridmend.operators import qdm, qplad
from helpers import noleap_series

DAYS = 20 * 365 + 15 + 15  # 1994-12-17 .. 2015-01-15


def fine_pair(spark, value):
    """Two fine cells under one coarse cell, over 20 full years and their pads."""
    return noleap_series(spark, 1994, DAYS, value("a"), cell="a", start_doy=351).unionByName(
        noleap_series(spark, 1994, DAYS, value("b"), cell="b", start_doy=351)
    )


def tiled(fine):
    coarse = qplad.spatial_mean(fine, ["v"]).withColumn("coarse_cell", F.lit(1))
    cells = fine.select("cell").distinct().withColumn("coarse_cell", F.lit(1))
    return qplad.broadcast_coarse(coarse, cells)


@pytest.fixture(scope="module")
def ones(spark):
    """Adjusted coarse year 2005 on both cells, and the model of a constant pair."""
    fine = fine_pair(spark, lambda _: F.lit(1.0))
    coarse = tiled(fine)
    hist = coarse.withColumn("v", F.col("v") + 2)
    adjusted = qdm.apply_qdm(hist, qdm.train_qdm(coarse, hist, "v", "*"), "v", [2005], "*").persist()
    model = qplad.train_qplad(coarse, fine, "v", "*").persist()
    assert model.count() == 730 and model.filter(F.size("af") != 620).count() == 0
    return adjusted, model


def downscaled(adjusted, model):
    rows = qplad.apply_qplad(adjusted, model, "v", "*").orderBy("cell", "date").collect()
    return [r["v"] for r in rows if r["cell"] == "a"], [r["v"] for r in rows if r["cell"] == "b"]


def test_spoiled_day_of_year(ones):
    adjusted, model = ones
    zero = F.transform("af", lambda f: f * 0)
    a, b = downscaled(adjusted, model.withColumn("af", F.when(F.col("doy") == 26, zero).otherwise(F.col("af"))))
    assert (a + b).count(1.0) == 728 and (a + b).count(0.0) == 2
    assert a[25] == b[25] == 0.0


def test_spoiled_cell(ones):
    adjusted, model = ones
    zero = F.transform("af", lambda f: f * 0)
    a, b = downscaled(adjusted, model.withColumn("af", F.when(F.col("cell") == "a", zero).otherwise(F.col("af"))))
    assert a == [0.0] * 365 and b == [1.0] * 365


@pytest.mark.parametrize("exact", [True, False])
def test_spoiled_quantile(ones, exact):
    adjusted, model = ones
    node = 310  # the constant pool ranks at 621 / 1240
    spoiled = F.transform("af", lambda f, i: F.when(i == node, F.lit(200.0)).otherwise(f))
    wrong = F.when((F.col("doy") == 101) & (F.col("cell") == "a"), spoiled).otherwise(F.col("af"))
    simulation = adjusted if exact else adjusted.drop("sim_rank2", "sim_n")
    a, _ = downscaled(simulation, model.withColumn("af", wrong))
    assert max(a) == 200 and a.index(200) == 100 and sum(a) == 564


@pytest.mark.parametrize("kind", ["+", "*"])
def test_fine_cells_average_back_to_the_coarse_value(spark, kind):
    fine = fine_pair(spark, lambda cell: 15 + 8 * F.abs(F.sin(F.col("id") * (1.7 if cell == "a" else 2.3))))
    coarse = tiled(fine)
    model = qplad.train_qplad(coarse, fine, "v", kind)
    simulation = qdm.sim_quantile(coarse, "v", [2004, 2005])
    out = qplad.apply_qplad(simulation, model, "v", kind)
    both = qplad.spatial_mean(out, ["v"]).join(coarse.filter("cell = 'a'").withColumnRenamed("v", "c"), "date")
    assert both.count() == 730
    assert both.filter(F.abs(F.col("v") - F.col("c")) > 1e-7).count() == 0


def test_wet_day_correction_uses_the_given_variable(ones):
    adjusted, model = ones
    halved = model.withColumn("af", F.transform("af", lambda f: f / 2))
    out = qplad.apply_qplad(adjusted, halved, "v", "*", wet_day_post_correction=True)
    assert {r["v"] for r in out.select("v").distinct().collect()} == {0.0}


def test_inputs_are_checked(spark):
    fine = fine_pair(spark, lambda _: F.lit(1.0))
    qplad.check_qplad_inputs(fine, fine)
    with pytest.raises(ValueError, match="time steps"):
        qplad.check_qplad_inputs(fine.filter("date > '1995-01-01'"), fine)
    with pytest.raises(ValueError, match="full years"):
        qplad.check_qplad_inputs(fine, fine, quantiles_n=600)
    with pytest.raises(ValueError, match="sim_q"):
        qplad.apply_qplad(fine, fine, "v", "+")
    with pytest.raises(Exception, match="not 600"):
        qplad.train_qplad(fine, fine, "v", "+", quantiles_n=600).select(F.max(F.size("af"))).collect()


def test_cells_that_one_side_knows_get_no_model(spark):
    fine = fine_pair(spark, lambda _: F.lit(1.0))
    only_coarse = tiled(fine).unionByName(noleap_series(spark, 1994, DAYS, F.lit(1.0), cell="coarse", start_doy=351))
    both = fine.unionByName(noleap_series(spark, 1994, DAYS, F.lit(2.0), cell="fine", start_doy=351))
    model = qplad.train_qplad(only_coarse, both, "v", "+")
    assert {(r["cell"], r["count"]) for r in model.groupBy("cell").count().collect()} == {("a", 365), ("b", 365)}
    assert model.filter(F.exists("af", lambda f: f.isNull())).isEmpty()
