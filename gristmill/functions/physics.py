"""Physical and kinetic formulas as column expressions, and bounds checks on their inputs.

Every formula takes columns (or numbers, or the name of a shape or form) by name and returns a double column. Inputs with a default may be
left out; any other null input gives null. Nothing leaves the JVM.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

#: Gas constant J/(mol K), vacuum permittivity F/m, Boltzmann constant J/K, elementary charge C, offset of the Celsius scale.
R, EPS0, KB, QE, ZERO_C = 8.314462618, 8.8541878128e-12, 1.380649e-23, 1.602176634e-19, 273.15
#: Fixed values, Choi and Okos (1986): per component a + b T + c T^2 with T in degrees Celsius; specific heat in kJ/(kg K), conductivity in W/(m K), density in kg/m3.
CHOI_OKOS = {
    "water": {"cp": (4.1762, -9.0864e-5, 5.4731e-6), "k": (0.57109, 1.7625e-3, -6.7036e-6), "rho": (997.18, 3.1439e-3, -3.7574e-3)},
    "protein": {"cp": (2.0082, 1.2089e-3, -1.3129e-6), "k": (0.17881, 1.1958e-3, -2.7178e-6), "rho": (1329.9, -0.5184, 0.0)},
    "fat": {"cp": (1.9842, 1.4733e-3, -4.8008e-6), "k": (0.18071, -2.7604e-3, -1.7749e-7), "rho": (925.59, -0.41757, 0.0)},
    "carb": {"cp": (1.5488, 1.9625e-3, -5.9399e-6), "k": (0.20141, 1.3874e-3, -4.3312e-6), "rho": (1599.1, -0.31046, 0.0)},
    "fiber": {"cp": (1.8459, 1.8306e-3, -4.6509e-6), "k": (0.18331, 1.2497e-3, -3.1683e-6), "rho": (1311.5, -0.36589, 0.0)},
    "ash": {"cp": (1.0926, 1.8896e-3, -3.6817e-6), "k": (0.32962, 1.4011e-3, -2.9069e-6), "rho": (2423.8, -0.28063, 0.0)},
}


#: Plank's P and R by shape.
PLANK = {"slab": (1 / 2, 1 / 8), "cylinder": (1 / 4, 1 / 16), "sphere": (1 / 6, 1 / 24)}
#: Antoine's A, B, C of water (mmHg, degrees Celsius, 1 to 100), metres in a mil.
WATER, MIL = (8.07131, 1730.63, 233.426), 2.54e-5


def _c(x: Column | float | str | None) -> Column | None:
    return x if isinstance(x, Column) or x is None else F.lit(x if isinstance(x, str) else float(x))


def erfc(x: Column) -> Column:
    """Complementary error function, by the Chebyshev fit of Numerical Recipes (relative error below 1.2e-7)."""
    #: The fit's coefficients.
    fit = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    z = F.abs(x)
    t = 1 / (1 + z / 2)
    poly = F.lit(fit[-1])
    for a in reversed(fit[:-1]):
        poly = poly * t + a
    value = t * F.exp(-z * z + poly)
    return F.when(x >= 0, value).otherwise(2 - value)


def _choi(kind: str, name: str, t: Column) -> Column:
    a, b, c = CHOI_OKOS[name][kind]
    return F.lit(a) + b * t + c * t * t


def _fractions(x: dict[str, Column]) -> dict[str, Column]:
    total = sum(x.values(), F.lit(0.0))
    return {k: v / F.nullif(total, F.lit(0.0)) for k, v in x.items()}


def _composition(kind: str, t: Column, x: dict[str, Column]) -> Column:
    x = _fractions({k: _c(v) for k, v in x.items()})
    if kind == "cp":
        return 1000 * sum((v * _choi("cp", k, t) for k, v in x.items()), F.lit(0.0))
    volume = {k: v / _choi("rho", k, t) for k, v in x.items()}
    whole = sum(volume.values(), F.lit(0.0))
    return 1 / whole if kind == "rho" else sum((v / whole * _choi("k", k, t) for k, v in volume.items()), F.lit(0.0))


def fourier_1d(T0, Tb, x, t, alpha=None, k=None, rho=None, Cp=None):
    """With the diffusivity alpha, or with k / (rho Cp) for it."""
    alpha = k / (rho * Cp) if alpha is None else alpha
    return F.when(t == 0, T0).otherwise(T0 + (Tb - T0) * erfc(x / (2 * F.sqrt(alpha * t))))


def specific_heat(T, water, protein, fat, carb, fiber, ash):
    return _composition("cp", T, {"water": water, "protein": protein, "fat": fat, "carb": carb, "fiber": fiber, "ash": ash})


def conductivity(T, water, protein, fat, carb, fiber, ash):
    return _composition("k", T, {"water": water, "protein": protein, "fat": fat, "carb": carb, "fiber": fiber, "ash": ash})


def density(T, water, protein, fat, carb, fiber, ash):
    return _composition("rho", T, {"water": water, "protein": protein, "fat": fat, "carb": carb, "fiber": fiber, "ash": ash})


def arrhenius(A, Ea, T_K):
    return A * F.exp(-Ea / (R * T_K))


def nusselt(C, Re, m, Pr, n):
    return C * F.pow(Re, m) * F.pow(Pr, n)


def plank_freezing(rho, L, d, Tf, Tinf, h, k, geometry=None, P=None, Rg=None):
    """P and R are given, or those of the geometry (a slab unless it is named)."""
    shape = F.lit("slab") if geometry is None else F.lower(geometry)
    of = lambda n: F.coalesce(*[F.when(shape == name, F.lit(v[n])) for name, v in PLANK.items()])
    P, Rg = of(0) if P is None else P, of(1) if Rg is None else Rg
    return rho * L * d / (Tf - Tinf) * (P / h + Rg * d / k)


def protein_denaturation(T_K, Td_K, dH):
    arg = (T_K - Td_K) / (R * Td_K * Td_K / dH)
    return 1 / (1 + F.exp(F.least(F.lit(700.0), F.greatest(F.lit(-700.0), arg))))


def dielectric_power(f, eps2, E):
    return 2 * F.pi() * f * EPS0 * eps2 * E * E


def ohmic_heating(sigma25, alpha, T, E):
    return F.greatest(F.lit(0.0), sigma25 * (1 + alpha * (T - 25))) * E * E


def respiration_heat(a, b, T):
    return a * F.exp(b * T)


def starch_gelatinization(A, Ea, T_K, t, n):
    arg = A * F.exp(-Ea / (R * T_K)) * F.pow(t, n)
    return F.when(arg > 700, 1.0).otherwise(-F.expm1(-arg))


def michaelis_menten(Vmax, S, Km):
    return Vmax * S / (Km + S)


def d_value(t, N, N0):
    return -t / F.log10(N / N0)


def z_value(T1, T2, D1, D2):
    return (T2 - T1) / F.log10(D1 / D2)


def f_value(T, Tref, z, seconds):
    return F.pow(F.lit(10.0), (T - Tref) / z) * seconds / 60


def f_value_profile(times, temperatures, Tref, z):
    """Simpson's rule over a sampled profile: two arrays of equal length, at any distances. Of an even number of samples, the last interval takes
    the parabola through the last three; two samples make a trapezoid."""
    rate, n = F.transform(temperatures, lambda t: F.pow(F.lit(10.0), (t - Tref) / z)), F.size(times)
    gap = lambda i: F.get(times, i + 1) - F.get(times, i)
    y = lambda i: F.get(rate, i)

    def pair(i):
        h0, h1 = gap(i), gap(i + 1)
        return (h0 + h1) / 6 * ((2 - h1 / h0) * y(i) + (h0 + h1) * (h0 + h1) / (h0 * h1) * y(i + 1) + (2 - h0 / h1) * y(i + 2))

    whole = F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)), F.lit(2)), pair), F.lit(0.0), lambda s, x: s + x)
    h0, h1 = gap(n - 3), gap(n - 2)
    rest = (2 * h1 * h1 + 3 * h0 * h1) / (6 * (h0 + h1)) * y(n - 1) + (h1 * h1 + 3 * h0 * h1) / (6 * h0) * y(n - 2) - h1 * h1 * h1 / (6 * h0 * (h0 + h1)) * y(n - 3)
    even = F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 4, F.lit(0)), F.lit(2)), pair), F.lit(0.0), lambda s, x: s + x) + rest
    return F.when(n < 2, 0.0).when(n == 2, gap(F.lit(0)) * (y(F.lit(0)) + y(F.lit(1))) / 2).when(n % 2 == 1, whole).otherwise(even) / 60


def gompertz(A, mu, lam, t):
    return A * F.exp(-F.exp(mu * F.exp(F.lit(1.0)) / A * (lam - t) + 1))


def growth_limit(pH=None, pH_min=None, aw=None, aw_min=None, T=None, T_min=None, conc=None, MIC=None):
    """1 if a value lies below its minimum, or the concentration reaches the MIC; else 0. Only pairs that are given count; null if one of those lacks a value, or none is given."""
    pairs = [(v, limit, name) for v, limit, name in ((pH, pH_min, "low"), (aw, aw_min, "low"), (T, T_min, "low"), (conc, MIC, "high")) if v is not None and limit is not None]
    lacking = reduce(lambda x, y: x | y, [v.isNull() | limit.isNull() for v, limit, _ in pairs], F.lit(not pairs))
    hurdle = reduce(lambda x, y: x | y, [(v < limit) if name == "low" else (v >= limit) for v, limit, name in pairs], F.lit(False))
    return F.when(~lacking, F.when(hurdle, 1.0).otherwise(0.0))


def binding(L, K=None, Kd=None, P=None):
    """The bound share of P by the exact quadratic; without P, K L / (1 + K L). K or Kd = 1 / K."""
    if P is None:
        K = 1 / Kd if K is None else K
        return K * L / (1 + K * L)
    b = P + L + (1 / K if Kd is None else Kd)
    return (b - F.sqrt(F.greatest(b * b - 4 * P * L, F.lit(0.0)))) / (2 * P)


def fick_second(Ci, Cb, D, x, t):
    return F.when(t == 0, Ci).otherwise(Ci + (Cb - Ci) * erfc(x / (2 * F.sqrt(D * t))))


def gab_isotherm(Wm, C, K, aw):
    return Wm * C * K * aw / ((1 - K * aw) * (1 - K * aw + C * K * aw))


def antoine(T, A=WATER[0], B=WATER[1], C=WATER[2]):
    """Water's constants unless others are given."""
    A, B, C = _c(A), _c(B), _c(C)
    return F.pow(F.lit(10.0), A - B / (T + C)) * 133.322


def henderson_hasselbalch(pKa, acid, base):
    return pKa + F.log10(base / acid)


def henry(H, p, form=None, T_K=None):
    """The concentration: H p (form c/p, the default), p / H (form p/c), or H c_gas with c_gas = p / (R T) (form c/c)."""
    direct, inverse = H * p, p / H
    gas = F.lit(None).cast("double") if T_K is None else H * p / (R * T_K)
    return direct if form is None else F.when(form == "c/p", direct).when(form == "p/c", inverse).when(form == "c/c", gas)


def latent_heat_water(T_K):
    """Watson's rule from the boiling point; null from the critical temperature on."""
    return F.when(T_K < 647.096, 2.2564e6 * F.pow((647.096 - T_K) / (647.096 - 373.15), F.lit(0.38)))


def partition(logP):
    return F.pow(F.lit(10.0), logP)


def gas_permeability(dp, thickness, P=None, P_O2=None, P_CO2=None):
    """With P in SI units; a permeability of O2 or CO2 is per mil of thickness, which is given in m."""
    film = P_O2 if P_O2 is not None else P_CO2
    return P * dp / thickness if film is None else film * dp / (thickness / MIL)


def osmotic_pressure(i, M, T_K):
    return i * M * 1000 * R * T_K


def membrane_transport(P, dC, thickness):
    return P * dC / thickness


def scf_solubility(k, rho, a, T_K, b):
    e = k * F.log(rho) + a / T_K + b
    return F.when(e > 700, float("inf")).when(e < -700, 0.0).otherwise(F.exp(e))


def power_law(K, rate, n):
    return K * F.pow(rate, n)


def herschel_bulkley(tau0, K, rate, n):
    return tau0 + K * F.pow(rate, n)


def casson(tau0, Kc, rate):
    return F.pow(F.sqrt(tau0) + F.sqrt(Kc * rate), F.lit(2.0))


def gordon_taylor(w1, Tg1, w2, Tg2, k):
    return (w1 * Tg1 + k * w2 * Tg2) / F.nullif(w1 + k * w2, F.lit(0.0))


def wlf(T, Tg, C1=17.44, C2=51.6):
    return F.pow(F.lit(10.0), -C1 * (T - Tg) / (C2 + T - Tg))


def stevens(k, I, n):  # noqa: E741
    return k * F.pow(I, n)


def griffith(E, gamma, a):
    return F.sqrt(2 * E * gamma / (F.pi() * a))


def stokes(r, rho_p, rho_f, g, eta):
    return 2 * r * r * (rho_p - rho_f) * g / (9 * eta)


def hlb(Mh, Ml):
    return 20 * Mh / (Mh + Ml)


def dlvo(A_H, r, D, eps_r, zeta, kappa, T_K):
    th = F.tanh(QE * zeta / (4 * KB * T_K))
    return -A_H * r / (12 * D) + 64 * F.pi() * EPS0 * eps_r * r * F.pow(KB * T_K / QE, F.lit(2.0)) * th * th * F.exp(-kappa * D)


def laplace(sigma, radius):
    return 2 * sigma / radius


def q10(k1, k2, T1, T2):
    return F.pow(k2 / k1, 10 / (T2 - T1))


FORMULAS: dict[str, Callable[..., Column]] = {
    "MF-T01": fourier_1d, "MF-T02-CP": specific_heat, "MF-T02-K": conductivity, "MF-T02-RHO": density, "MF-T03": arrhenius, "MF-T04": nusselt,
    "MF-T05": plank_freezing, "MF-T06": protein_denaturation, "MF-T07": dielectric_power, "MF-T08": ohmic_heating, "MF-T09": respiration_heat,
    "MF-T10": starch_gelatinization, "MF-K01": michaelis_menten, "MF-K02": d_value, "MF-K03": z_value, "MF-K04": f_value, "MF-K05": gompertz,
    "MF-K06": growth_limit, "MF-K07": binding, "MF-M01": fick_second, "MF-M02": gab_isotherm, "MF-M03": antoine,
    "MF-M04": henderson_hasselbalch, "MF-M05": henry, "MF-M06": latent_heat_water, "MF-M07": partition, "MF-M08": gas_permeability,
    "MF-M09": osmotic_pressure, "MF-M10": membrane_transport, "MF-M11": scf_solubility, "MF-R01": power_law, "MF-R02": herschel_bulkley,
    "MF-R03": casson, "MF-R04": gordon_taylor, "MF-R05": wlf, "MF-R06": stevens, "MF-R07": griffith, "MF-C01": stokes, "MF-C02": hlb,
    "MF-C03": dlvo, "MF-C04": laplace, "MF-C05": q10,
}


def evaluate(formula: str, **inputs: Column | float) -> Column:
    """A formula of FORMULAS with columns or numbers for its parameters."""
    f = FORMULAS[formula]
    known = inspect.signature(f).parameters
    if missing := [p for p, v in known.items() if p not in inputs and v.default is inspect.Parameter.empty] + [p for p in inputs if p not in known]:
        raise ValueError(f"{formula}: missing or unknown parameters {missing}")
    return f(**{k: _c(v) for k, v in inputs.items()})


def solved(formula: str, unit: str, symbol: str, bounds: dict[str, tuple[float | None, float | None, bool]], **inputs: Column | float) -> Column:
    """What a solver answers: a struct of result, valid, issues (of inputs out of bounds, of a result that is no finite number), inputs (name to value), formula, unit and summary."""
    given = {k: _c(v) for k, v in inputs.items() if not isinstance(v, str)}
    value = evaluate(formula, **inputs)
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    issues = F.concat(_issues({k: (given[k], *b) for k, b in bounds.items()}), F.when(finite, F.array().cast("array<string>")).otherwise(F.array(F.lit("result is not finite"))))
    inputs_used = F.map_from_arrays(F.array(*map(F.lit, given)), F.array(*[v.cast("double") for v in given.values()]))
    summary = F.concat_ws(" ", F.lit(symbol), F.lit("="), F.format_string("%.4e", value), F.lit(unit))
    return F.struct(F.when(finite, value).alias("result"), passed(issues).alias("valid"), issues.alias("issues"), inputs_used.alias("inputs"), F.lit(formula).alias("formula"), F.lit(unit).alias("unit"), F.when(finite, summary).alias("summary"))


def _issues(bounds: dict[str, tuple[Column, float | None, float | None, bool]]) -> Column:
    found = []
    for name, (column, low, high, soft) in bounds.items():
        c, prefix = column.cast("double"), "WARN: " if soft else ""
        missing = F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(f"{prefix}{name} missing"))
        found.append(missing.when((c < low) if low is not None else F.lit(False), F.lit(f"{prefix}{name} below {low}")).when((c > high) if high is not None else F.lit(False), F.lit(f"{prefix}{name} above {high}")))
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")


def bounds_issues(bounds: dict[str, tuple[float | None, float | None, bool]], derived: dict[str, Column] | None = None) -> Column:
    """An array of issues, one for each bounded value that is missing, not finite or out of range; soft bounds give issues that begin with WARN:.

    A name is a column, a field of a struct by its dotted path, or one of the derived values.
    """
    return _issues({name: ((derived or {}).get(name, F.col(name)), *b) for name, b in bounds.items()})


def as_shares(parts: dict[str, Column]) -> dict[str, Column]:
    """Parts of a composition as shares of 1: percents (a sum above 10) are divided by 100."""
    percents = reduce(lambda x, y: x + y, [F.coalesce(v, F.lit(0.0)) for v in parts.values()]) > 10
    return {k: F.when(percents, v / 100).otherwise(v) for k, v in parts.items()}


def passed(issues: Column) -> Column:
    return ~F.exists(issues, lambda i: ~i.startswith("WARN:"))
