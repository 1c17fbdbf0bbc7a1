"""Array expressions for row-local vector work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(arr) -> Column:
    return (F.col(arr) if isinstance(arr, str) else arr).cast("array<double>")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row.

    A lambda that mentions an outer expression evaluates it again for every element; binding it as a
    lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)


def mean(arr: Column) -> Column:
    return total(arr) / F.size(arr)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def l2(arr: Column) -> Column:
    return F.sqrt(dot(arr, arr))


def norm(arr: Column, p) -> Column:
    """L0 counts non-zeros, Lp is the p-th root of the summed powers, inf the largest absolute value."""
    if p == 0:
        return F.size(F.filter(arr, lambda x: x != 0)).cast("double")
    if p == float("inf"):
        return F.array_max(F.transform(arr, F.abs))
    return F.pow(total(F.transform(arr, lambda x: F.pow(F.abs(x), F.lit(float(p))))), F.lit(1.0 / p))


def clip_to_norm(arr: Column, theta: float, size: Column | None = None) -> Column:
    """Scale by min(1, theta / norm)."""

    def scale(v):
        length = l2(v) if size is None else size
        factor = F.least(F.lit(1.0), F.lit(theta) / F.greatest(length, F.lit(1e-300)))
        return let(factor, lambda f: F.transform(v, lambda x: x * f))

    return let(arr, scale)


def softmax(arr: Column) -> Column:
    def exps(v):
        return let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))

    return let(exps(arr), lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))


def masked_softmax(arr: Column, valid: Column) -> Column:
    """Softmax over the first `valid` entries; the others get weight 0."""
    kept = F.slice(arr, F.lit(1), F.least(F.greatest(valid, F.lit(1)), F.size(arr)))
    fill = F.array_repeat(F.lit(0.0), F.size(arr))
    return F.slice(F.concat(softmax(kept), fill), F.lit(1), F.size(arr))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def leaky_relu(x: Column, slope: float = 0.01) -> Column:
    return F.when(x > 0, x).otherwise(x * slope)


def layer_norm(arr: Column, eps: float = 1e-6) -> Column:
    def centred(v):
        return let(mean(v), lambda mu: F.transform(v, lambda x: x - mu))

    def scaled(c):
        return let(F.sqrt(dot(c, c) / F.size(c) + F.lit(eps)), lambda sd: F.transform(c, lambda x: x / sd))

    return let(arr, lambda v: let(centred(v), scaled))


def outer(a: Column, b: Column, op) -> Column:
    """op(x, y) for every x of a and y of b, row-major."""
    return let(b, lambda bs: F.flatten(F.transform(a, lambda x: F.transform(bs, lambda y: op(x, y)))))


def positions_where(arr: Column, pred) -> Column:
    """0-based positions of the elements that match."""
    marked = F.transform(arr, lambda x, i: F.when(pred(x), i))
    return F.filter(marked, lambda i: i.isNotNull())


def argmax(arr: Column) -> Column:
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def argmin(arr: Column) -> Column:
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argsort(arr: Column) -> Column:
    """0-based positions in ascending value order, equal values by position."""
    pairs = F.transform(arr, lambda x, i: F.struct(x.alias("v"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda p: p["i"])


def transpose(arr: Column, dims: tuple[int, ...], axes: tuple[int, ...]) -> Column:
    """Reorder a flat row-major array of the given dims to the given axis order."""
    strides = [1] * len(dims)
    for i in range(len(dims) - 2, -1, -1):
        strides[i] = strides[i + 1] * dims[i + 1]
    shape = [dims[a] for a in axes]
    size = 1
    for d in shape:
        size *= d

    def source(i):
        at, rest = F.lit(0), i
        for d, a in zip(reversed(shape), reversed(axes)):
            at = at + (rest % d) * strides[a]
            rest = F.floor(rest / d).cast("int")
        return at

    spots = F.sequence(F.lit(0), F.lit(size - 1))
    return let(arr, lambda v: F.transform(spots, lambda i: F.get(v, source(i))))


def pad(arr: Column, n: int, value) -> Column:
    """Cut to n elements or fill up to n with value."""
    return F.slice(F.concat(arr, F.array_repeat(F.lit(value), n)), 1, n)


def one_hot(index: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: (j == index).cast("int"))


def mask_after(arr: Column, valid: Column, value) -> Column:
    return F.transform(arr, lambda x, i: F.when(i < valid, x).otherwise(F.lit(value)))


def scaled6(arr: Column) -> Column:
    """Numbers as text, six decimals, scaled to whole numbers (for exact comparison)."""
    whole = F.transform(arr, lambda x: F.floor(x * 1000000 + 0.5).cast("string"))
    return F.array_join(whole, ",")
