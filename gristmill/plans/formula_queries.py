"""Every formula over the given tables, one query for each family, with SQL that spells the formulas out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import physics
from .registry import query, read

#: The columns that inputs are made of: s from 1 to 50, y from 0 to 1.
_INPUTS = "(select p_partkey, p_size::double as s, (p_retailprice - 900) / 100 as y from part)"
_R = physics.R


def _over_parts(spark: SparkSession, sf_dir: str, made: dict[str, Column]) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("s"), ((F.col("p_retailprice") - 900) / 100).alias("y"))
    return p.select("p_partkey", *[F.round(v, 6).alias(k) for k, v in made.items()])


def _sql(made: dict[str, str], more: str = "") -> str:
    return f"select p_partkey, {', '.join(f'round({v}, 6) as {k}' for k, v in made.items())} from (select *{more} from {_INPUTS})"


_SHARES = {"water": "(0.5 + 0.3 * y)", "protein": "(0.1 + s / 500)", "fat": "0.1", "carb": "0.1", "fiber": "0.02", "ash": "0.01"}
_SUM = "(" + " + ".join(_SHARES.values()) + ")"
_T = "(10 + s)"


def _poly(name: str, kind: str) -> str:
    a, b, c = physics.CHOI_OKOS[name][kind]
    return f"({a} + {b} * {_T} + {c} * {_T} * {_T})"


_VOLUMES = {n: f"({v} / {_SUM} / {_poly(n, 'rho')})" for n, v in _SHARES.items()}
_VOLUME = "(" + " + ".join(_VOLUMES.values()) + ")"
_HEAT_ARG = "((0.001 + s / 5000) / (2 * sqrt((0.5 + y) / (1000 * 4000.0) * 60 * s)))"
_FIT = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)  # as in physics.erfc


def _erfc(x: str) -> str:
    t = f"(1 / (1 + {x} / 2))"
    poly = str(_FIT[-1])
    for a in reversed(_FIT[:-1]):
        poly = f"({poly} * {t} + {a})"
    return f"({t} * exp(-{x} * {x} + {poly}))"


@query(_sql({
    "t01": f"20 + 80 * {_erfc(_HEAT_ARG)}",
    "t02_cp": "1000 * (" + " + ".join(f"{v} / {_SUM} * {_poly(n, 'cp')}" for n, v in _SHARES.items()) + ")",
    "t02_k": " + ".join(f"{v} / {_VOLUME} * {_poly(n, 'k')}" for n, v in _VOLUMES.items()),
    "t02_rho": f"1 / {_VOLUME}",
    "t03": f"5e9 * exp(-60000 / ({_R} * (273.15 + s)))",
    "t04": "0.023 * pow(10000 + 100 * s, 0.8) * pow(5 + y, 0.4)",
    "t05": "1050 * 250000.0 * (0.01 + s / 1000) / (-1 + 30) * (1 / 6.0 / 20 + 1 / 24.0 * (0.01 + s / 1000) / 1.5) / 1000",
    "t06": f"1 / (1 + exp(((300 + s) - 340) / ({_R} * 340 * 340 / 400000.0)))",
    "t07": "2 * pi() * 2.45e9 * 8.8541878128e-12 * (10 + s) * pow(100 * y, 2)",
    "t08": "greatest(0, 0.5 * (1 + 0.02 * (s - 25))) * pow(100 * y, 2)",
    "t09": "20 * exp(0.1 * s)",
    "t10": f"1 - exp(-1e8 * exp(-70000 / ({_R} * (330 + s))) * pow(60 * y, 1.2))",
}))
def formulas_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, y, e, t = F.col("s"), F.col("y"), physics.evaluate, 10 + F.col("s")
    shares = {"water": 0.5 + 0.3 * y, "protein": 0.1 + s / 500, "fat": 0.1, "carb": 0.1, "fiber": 0.02, "ash": 0.01}
    return _over_parts(spark, sf_dir, {
        "t01": e("MF-T01", T0=20.0, Tb=100.0, x=0.001 + s / 5000, t=60 * s, k=0.5 + y, rho=1000.0, Cp=4000.0),
        "t02_cp": e("MF-T02-CP", T=t, **shares), "t02_k": e("MF-T02-K", T=t, **shares), "t02_rho": e("MF-T02-RHO", T=t, **shares),
        "t03": e("MF-T03", A=5e9, Ea=60000.0, T_K=s + 273.15), "t04": e("MF-T04", C=0.023, Re=10000 + 100 * s, m=0.8, Pr=5 + y, n=0.4),
        "t05": e("MF-T05", rho=1050.0, L=250000.0, d=0.01 + s / 1000, Tf=-1.0, Tinf=-30.0, h=20.0, k=1.5, geometry="sphere") / 1000,
        "t06": e("MF-T06", T_K=300 + s, Td_K=340.0, dH=400000.0), "t07": e("MF-T07", f=2.45e9, eps2=10 + s, E=100 * y), "t08": e("MF-T08", sigma25=0.5, alpha=0.02, T=s, E=100 * y),
        "t09": e("MF-T09", a=20.0, b=0.1, T=s), "t10": e("MF-T10", A=1e8, Ea=70000.0, T_K=330 + s, t=60 * y, n=1.2),
    })


@query(_sql({
    "k01": "10 * s / (5 + s)",
    "k02": "-(1 + y) / log10((1 + s) / 1000)",
    "k03": "s / log10(100 / (1 + y))",
    "k04": "pow(10, (120 + y - 121.1) / 10) * (60 * s) / 60",
    "k04_profile": "(s * 60) * (pow(10, (100 + y - 121.1) / 10) + 4 * pow(10, (110 + y - 121.1) / 10) + pow(10, (115 + y - 121.1) / 10)) / 3 / 60",
    "k05": "8 * exp(-exp(0.5 * exp(1) / 8 * (2 - s) + 1))",
    "k06": "case when 4 + y < 4.6 or s / 50 < 0.5 then 1 else 0 end",
    "k06_mic": "case when s >= 25 then 1 else 0 end",
    "k07": "((1 + s + 2) - sqrt(pow(1 + s + 2, 2) - 4 * 1 * s)) / (2 * 1)",
    "k07_open": "s / 2 / (1 + s / 2)",
}))
def formulas_kinetics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, y, e = F.col("s"), F.col("y"), physics.evaluate
    profile = physics.f_value_profile(F.array(F.lit(0.0), 60 * s, 120 * s), F.array(100 + y, 110 + y, 115 + y), F.lit(121.1), F.lit(10.0))
    return _over_parts(spark, sf_dir, {
        "k01": e("MF-K01", Vmax=10.0, S=s, Km=5.0), "k02": e("MF-K02", t=1 + y, N=1 + s, N0=1000.0), "k03": e("MF-K03", T1=100.0, T2=100 + s, D1=100.0, D2=1 + y),
        "k04": e("MF-K04", T=120 + y, Tref=121.1, z=10.0, seconds=60 * s), "k04_profile": profile, "k05": e("MF-K05", A=8.0, mu=0.5, lam=2.0, t=s),
        "k06": e("MF-K06", pH=4 + y, pH_min=4.6, aw=s / 50, aw_min=0.5), "k06_mic": e("MF-K06", conc=s, MIC=25.0), "k07": e("MF-K07", L=s, Kd=2.0, P=1.0), "k07_open": e("MF-K07", L=s, Kd=2.0),
    })


_MASS_ARG = "((0.001 + s / 10000) / (2 * sqrt(1e-9 * 3600 * s)))"


@query(_sql({
    "m01": f"1 + (10 - 1) * {_erfc(_MASS_ARG)}",
    "m02": "0.06 * 10 * 0.8 * (s / 60) / ((1 - 0.8 * s / 60) * (1 - 0.8 * s / 60 + 10 * 0.8 * s / 60))",
    "m03": "pow(10, 8.07131 - 1730.63 / (20 + s + 233.426)) * 133.322",
    "m04": "4.76 + log10((0.1 + y) / (s / 10))",
    "m05": "2 * s",
    "m05_gas": f"0.5 * s * 1000 / ({_R} * (290 + s))",
    "m06": "2.2564e6 * pow((647.096 - (300 + s)) / (647.096 - 373.15), 0.38) / 1000",
    "m07": "pow(10, 2 * y - 1)",
    "m08": "3e-3 * s / (0.001 + y)",
    "m08_film": "2 * s / ((0.00005 + y / 1e5) / 2.54e-5)",
    "m09": f"2 * (0.1 + y) * 1000 * {_R} * (280 + s) / 1000",
    "m10": "1e-4 * s / (0.001 + y)",
    "m11": "exp(3 * ln(300 + s) + -4000 / (310 + s) + -8)",
}))
def formulas_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, y, e = F.col("s"), F.col("y"), physics.evaluate
    return _over_parts(spark, sf_dir, {
        "m01": e("MF-M01", Ci=1.0, Cb=10.0, D=1e-9, x=0.001 + s / 10000, t=3600 * s), "m02": e("MF-M02", Wm=0.06, C=10.0, K=0.8, aw=s / 60), "m03": e("MF-M03", T=20 + s),
        "m04": e("MF-M04", pKa=4.76, acid=s / 10, base=0.1 + y), "m05": e("MF-M05", H=2.0, p=s), "m05_gas": e("MF-M05", H=0.5, p=s * 1000, form="c/c", T_K=290 + s), "m06": e("MF-M06", T_K=300 + s) / 1000,
        "m07": e("MF-M07", logP=2 * y - 1), "m08": e("MF-M08", P=3e-3, dp=s, thickness=0.001 + y), "m08_film": e("MF-M08", P_O2=2.0, dp=s, thickness=0.00005 + y / 1e5), "m09": e("MF-M09", i=2.0, M=0.1 + y, T_K=280 + s) / 1000,
        "m10": e("MF-M10", P=1e-4, dC=s, thickness=0.001 + y), "m11": e("MF-M11", k=3.0, rho=300 + s, a=-4000.0, T_K=310 + s, b=-8.0),
    })


@query(_sql({
    "r01": "2.5 * pow(s, 0.6)",
    "r02": "10 * y + 1.2 * pow(s, 0.6)",
    "r03": "pow(sqrt(10 * y) + sqrt(0.5 * s), 2)",
    "r04": "((0.2 + y / 2) * 373 + 0.3 * (0.8 - y / 2) * 138) / ((0.2 + y / 2) + 0.3 * (0.8 - y / 2))",
    "r05": "pow(10, -17.44 * s / (51.6 + s))",
    "r06": "1.5 * pow(s, 1.3)",
    "r07": "sqrt(2 * (1e6 * s) * (1 + y) / (pi() * 0.001)) / 1000",
    "c01": "2 * pow(s * 1e-6, 2) * (1000 - 900) * 9.81 / (9 * (0.001 + y)) * 1e6",
    "c02": "20 * s / (s + 30)",
    "c03": "(-1e-20 * 1e-7 / (12 * s * 1e-9) + 64 * pi() * 8.8541878128e-12 * 78.5 * 1e-7 * pow(1.380649e-23 * 298.15 / 1.602176634e-19, 2) * pow((exp(2 * x) - 1) / (exp(2 * x) + 1), 2) * exp(-1e8 * s * 1e-9)) * 1e18",
    "c04": "2 * 0.03 / (s * 1e-6) / 1000",
    "c05": "pow((2 + y) / 1, 10 / s)",
}, ", 1.602176634e-19 * (0.02 + y / 50) / (4 * 1.380649e-23 * 298.15) as x"))
def formulas_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, y, e = F.col("s"), F.col("y"), physics.evaluate
    return _over_parts(spark, sf_dir, {
        "r01": e("MF-R01", K=2.5, rate=s, n=0.6), "r02": e("MF-R02", tau0=10 * y, K=1.2, rate=s, n=0.6), "r03": e("MF-R03", tau0=10 * y, Kc=0.5, rate=s),
        "r04": e("MF-R04", w1=0.2 + y / 2, Tg1=373.0, w2=0.8 - y / 2, Tg2=138.0, k=0.3), "r05": e("MF-R05", T=50 + s, Tg=50.0), "r06": e("MF-R06", k=1.5, I=s, n=1.3), "r07": e("MF-R07", E=1e6 * s, gamma=1 + y, a=0.001) / 1000,
        "c01": e("MF-C01", r=s * 1e-6, rho_p=1000.0, rho_f=900.0, g=9.81, eta=0.001 + y) * 1e6, "c02": e("MF-C02", Mh=s, Ml=30.0),
        "c03": e("MF-C03", A_H=1e-20, r=1e-7, D=s * 1e-9, eps_r=78.5, zeta=0.02 + y / 50, kappa=1e8, T_K=298.15) * 1e18, "c04": e("MF-C04", sigma=0.03, radius=s * 1e-6) / 1000, "c05": e("MF-C05", k1=1.0, k2=2 + y, T1=20.0, T2=20 + s),
    })


@query(f"""
select p_partkey, case when y > 0 then round(4.76 + log10(case when y > 0 then y end / s), 6) end as result, s between 5 and 45 and y > 0 as valid, s as acid_used, y as base_used,
  array_to_string(list_filter([case when s < 5 then 'acid below 5.0' when s > 45 then 'acid above 45.0' end, case when y < 0.1 then 'WARN: base below 0.1' end, case when y <= 0 then 'result is not finite' end], lambda i: i is not null), ';') as issues from {_INPUTS}
""")
def solver_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a solver of the registry answers: result, hard and soft issues, and the inputs that it used; a result that is no finite number is an issue, never an error."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("s"), ((F.col("p_retailprice") - 900) / 100).alias("y"))
    answer = physics.solved("MF-M04", "pH", "pH", {"acid": (5.0, 45.0, False), "base": (0.1, None, True)}, pKa=4.76, acid=F.col("s"), base=F.col("y"))
    return p.withColumn("x", answer).select("p_partkey", F.round("x.result", 6).alias("result"), "x.valid", F.col("x.inputs")["acid"].alias("acid_used"), F.col("x.inputs")["base"].alias("base_used"), F.array_join("x.issues", ";").alias("issues"))
