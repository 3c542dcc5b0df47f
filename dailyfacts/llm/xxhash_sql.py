"""DuckDB SQL of the 64-bit xxHash of texts, for the SQL of registered queries."""

from __future__ import annotations

from itertools import count

# The five primes of the hash.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261
_ALL = 1 << 64


def _number(n: int) -> str:
    return f"{n % _ALL}::uhugeint"


def _low(value: str) -> str:
    """The value's 64 low bits."""
    return f"(({value}) % {_ALL}::uhugeint)"


class _Names:
    """Expressions with names of their own for values that they use twice."""

    def __init__(self):
        self.numbers = count()

    def bound(self, value: str, body) -> str:
        name = f"x{next(self.numbers)}"
        return f"([{body(name)} for {name} in [{value}]][1])"

    def rotated(self, value: str, by: int) -> str:
        return self.bound(value, lambda x: f"{_low(f'{x} * {_number(1 << by)}')} + {x} // {_number(1 << (64 - by))}")

    def folded(self, value: str, by: int) -> str:
        return self.bound(value, lambda x: f"xor({x}, {x} // {_number(1 << by)})")


def _times(value: str, prime: int) -> str:
    return _low(f"{value} * {_number(prime)}")


def _bytes(at: str, size: int) -> str:
    """The number that bytes of the hexadecimal text ``x`` are, the lowest first."""
    pairs = [f"substr(x, ({at}) * 2 + {2 * (size - 1 - j) + 1}, 2)" for j in range(size)]
    return f"('0x' || {' || '.join(pairs)})::ubigint::uhugeint"


def xxhash64(words: str, seed: int) -> str:
    """A statement that gives ``s, h`` for each text ``s`` of the table ``words``; ``h`` is UHUGEINT."""
    names = _Names()

    def round_(before: str, lane: str) -> str:
        return _times(names.rotated(_low(f"{before} + {_times(lane, P2)}"), 31), P1)

    def merged(before: str, lane: str) -> str:
        return _low(f"{_times(f'xor({before}, {round_(_number(0), lane)})', P1)} + {_number(P4)}")

    def eight(before: str, lane: str) -> str:
        mixed = names.rotated(f"xor({before}, {round_(_number(0), lane)})", 27)
        return _low(f"{_times(mixed, P1)} + {_number(P4)}")

    starts = ", ".join(map(_number, (seed + P1 + P2, seed + P2, seed, seed - P1)))
    together = _low(" + ".join(names.rotated(f"v[{i}]", by) for i, by in ((1, 1), (2, 7), (3, 12), (4, 18))))
    four_bytes = _bytes("size - size % 8", 4)
    four = names.rotated(f"xor(h, {_times(four_bytes, P1)})", 23)
    one = names.rotated(f"xor(acc, {_times('b', P5)})", 11)
    last = names.folded(_times(names.folded(_times(names.folded("h", 33), P2), 29), P3), 32)
    return f"""
with named as (select s, hex(encode(s)) as x, octet_length(encode(s))::bigint as size from {words}),
laned as (select s, x, size, size // 32 as stripes, [{_bytes("8 * l", 8)} for l in range(size // 8)] as lanes from named),
striped as (
  select *, [list_reduce([lanes[4 * k + i + 1] for k in range(stripes)],
    lambda acc, lane: {round_("acc", "lane")}, [{starts}][i + 1]) for i in range(4)] as v from laned
),
joined as (
  select s, x, size, lanes[4 * stripes + 1 :] as lanes, {_low(f'''size::uhugeint + case when stripes > 0
    then list_reduce(v, lambda acc, lane: {merged("acc", "lane")}, {together})
    else {_number(seed + P5)} end''')} as h from striped
),
eights as (
  select s, x, size, list_reduce(lanes, lambda acc, lane: {eight("acc", "lane")}, h) as h from joined
),
fours as (
  select s, x, size, case when size % 8 >= 4 then {_low(f"{_times(four, P2)} + {_number(P3)}")} else h end as h from eights
),
ones as (
  select s, list_reduce([{_bytes("l", 1)} for l in range(size - size % 4, size)],
    lambda acc, b: {_times(one, P1)}, h) as h from fours
)
select s, {last} as h from ones"""
