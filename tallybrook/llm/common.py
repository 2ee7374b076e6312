"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are neither space nor one of tab to return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"

_PRIME = 2147483647


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_MULTIPLIERS = (1000003, 999983, 1000033)
_ROUNDS = 4


def permuted(place: Column, size: Column, key: Column) -> Column:
    """The image of ``place`` under a pseudorandom permutation of 0 to size - 1.

    A multiplication by a prime that doesn't divide the size comes first. Then each
    round of a swap-or-not shuffle pairs the places x and pivot - x and swaps them or
    not, by a bit that only depends on the pair. So it is a permutation for any size,
    with no table and no retry. Only whole-number arithmetic is used, which other
    engines have too.
    """
    key = key % _PRIME
    first, second, third = _MULTIPLIERS
    factor = F.when(size % first != 0, first).when(size % second != 0, second).otherwise(third)

    def turn(x: Column, r: Column) -> Column:
        high = (key * (r * 7919 + 104729) + r * 1299709) % _PRIME
        low = (key * (r * 15731 + 789221) + r * 2750159) % _PRIME
        other = ((high * _PRIME + low) % size - x + size) % size
        larger = F.greatest(x, other) % _PRIME
        coin = (larger * (r * 15485863 + 32452843) + key * 49979687 + r * 86028121) % _PRIME
        return F.when(F.shiftright(coin, 13) % 2 == 1, other).otherwise(x)

    steps = F.array(*[F.lit(number).cast("long") for number in range(1, _ROUNDS + 1)])
    return F.aggregate(steps, (place * factor + key) % size, turn)


def permuted_sql(place: str, size: str, key: str) -> str:
    """The same for DuckDB."""
    first, second, third = _MULTIPLIERS
    factor = f"CASE WHEN ({size}) % {first} <> 0 THEN {first} WHEN ({size}) % {second} <> 0 THEN {second} ELSE {third} END"
    key = f"(({key}) % {_PRIME})"
    high = f"(({key} * (r * 7919 + 104729) + r * 1299709) % {_PRIME})"
    low = f"(({key} * (r * 15731 + 789221) + r * 2750159) % {_PRIME})"
    other = f"((({high} * {_PRIME} + {low}) % ({size}) - x + ({size})) % ({size}))"
    larger = f"(greatest(x, {other}) % {_PRIME})"
    coin = f"(({larger} * (r * 15485863 + 32452843) + {key} * 49979687 + r * 86028121) % {_PRIME})"
    steps = ", ".join(str(number) for number in range(1, _ROUNDS + 1))
    return (
        f"list_reduce([((({place}) * ({factor}) + {key}) % ({size}))::BIGINT, {steps}], "
        f"lambda x, r: CASE WHEN ({coin} >> 13) % 2 = 1 THEN {other} ELSE x END)"
    )
