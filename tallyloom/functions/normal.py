"""Normal quantile as a column expression; tails as small Python helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of algorithm AS 241 (Wichura 1988), lowest power first.
CENTRAL_TOP = [
    3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
    45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727,
]
CENTRAL_BOTTOM = [
    1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
    21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610,
]
MIDDLE_TOP = [
    1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
    1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640,
]
MIDDLE_BOTTOM = [
    1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
    0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 0.00000000105075007164441684324,
]
FAR_TOP = [
    6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
    0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 0.000000201033439929228813265,
]
FAR_BOTTOM = [
    1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
    0.000786869131145613259100, 0.0000184631831751005468180, 0.000000142151175831644588870,
    0.00000000000000204426310338993978564,
]


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    result = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        result = result * x + F.lit(c)
    return result


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, 0 < p < 1, to about 1e-15."""
    centred = p - F.lit(0.5)
    inner = F.lit(0.180625) - centred * centred
    tail = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))
    middle = tail - F.lit(1.6)
    far = tail - F.lit(5.0)
    outer = F.when(tail <= 5.0, _polynomial(middle, MIDDLE_TOP) / _polynomial(middle, MIDDLE_BOTTOM)).otherwise(
        _polynomial(far, FAR_TOP) / _polynomial(far, FAR_BOTTOM)
    )
    return F.when(
        F.abs(centred) <= 0.425, centred * _polynomial(inner, CENTRAL_TOP) / _polynomial(inner, CENTRAL_BOTTOM)
    ).otherwise(F.signum(centred) * outer)


def plotting_position(rank: Column, n: Column) -> Column:
    """Filliben's estimate of the uniform order-statistic medians."""
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (
        F.when(rank == n, top)
        .when(rank == 1, F.lit(1.0) - top)
        .otherwise((rank - F.lit(0.3175)) / (n + F.lit(0.365)))
    )


def upper_tail(z: float) -> float:
    """P(Z > z) for a standard normal Z."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))
