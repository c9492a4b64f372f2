"""Pseudonyms and noise that stay the same for all rows of a person, and noise per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from veil.functions.scalar import keyed_between, random_between
from veil.functions.templates import Step, as_list
from veil.operators.identity import number_rows
from veil.operators.lookup import lookup
from veil.operators.store import Store
from veil.plans.tables import keep

VALUE = "_value"
# makes the pseudonym table of the keys of a table, numbering from a start
Build = Callable[[DataFrame, int], DataFrame]


def distinct_keys(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.select(*keys).distinct()


def counter_table(df: DataFrame, keys: Sequence[str], start: int = 1, seed=None) -> DataFrame:
    """Number the distinct keys 1..N, in key order, or with a seed in a secret order."""
    found = distinct_keys(df, keys)
    if seed is None:
        return number_rows(found, *keys, column=VALUE, start=start)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    shuffled = found.withColumn("_secret", F.sha2(text, 256))
    return number_rows(shuffled, "_secret", *keys, column=VALUE, start=start).drop("_secret")


def noise_table(df: DataFrame, keys: Sequence[str], bounds: Sequence[int]) -> DataFrame:
    """One random integer in ``bounds`` per distinct key."""
    return distinct_keys(df, keys).withColumn(VALUE, random_between(*bounds))


def date_noise_table(df: DataFrame, keys: Sequence[str], days=None, minutes=None) -> DataFrame:
    """One random ``[days, minutes]`` pair per distinct key; an absent range gives 0."""
    pair = [random_between(*r) if r else F.lit(0).cast("long") for r in (days, minutes)]
    return distinct_keys(df, keys).withColumn(VALUE, F.array(*pair))


def pseudonym_table(df: DataFrame, keys: Sequence[str], build: Build, path: str, extend: bool = False) -> DataFrame:
    """The table of a build function over the distinct keys of ``df``, written once and then reused.

    ``extend`` adds keys that are new since, as a version that is published whole or not at all; without
    it they have no entry. One writer at a time.
    """
    store = Store(df.sparkSession, path, keys)
    table = store.table()
    if table is None:
        store.publish(build(df, 1))
        return store.table()
    if extend:
        fresh = keep(store.missing(df), "new-keys")
        if fresh.rows:
            # only a counter goes on from the highest number; noise ignores the start
            is_number = table.schema[VALUE].dataType.typeName() == "long"
            last = table.agg(F.max(VALUE)).first()[0] if is_number else 0
            store.publish(build(fresh.df, (last or 0) + 1))
            table = store.table()
    return table


def person_counter(df: DataFrame, step: Step) -> DataFrame:
    """Replace a person key by a sequential number shared by all rows and runs."""
    seed = step.config.get("seed")
    return _lookup_person(
        df, step, lambda d, start: counter_table(d, _keys(step), start, seed), {step.output: VALUE}
    )


def person_noise(df: DataFrame, step: Step) -> DataFrame:
    """Add an integer that is constant per person."""
    bounds = step.config["range"]
    if _is_keyed(step):
        noise = keyed_between(*bounds, step.config["seed"], "value", *_match(step))
        df = df.withColumn(step.noise, noise)
    else:
        df = _lookup_person(df, step, lambda d, _: noise_table(d, _keys(step), bounds), {step.noise: VALUE})
    return df.withColumn(step.output, step.expr(step.config["origin"]) + F.col(step.noise))


def person_noise_date(df: DataFrame, step: Step) -> DataFrame:
    """Shift a date or timestamp by days and minutes that are constant per person."""
    days, minutes = step.config.get("range_day"), step.config.get("range_minute")
    if _is_keyed(step):
        seed = step.config["seed"]
        pair = [
            keyed_between(*r, seed, purpose, *_match(step)) if r else F.lit(0).cast("long")
            for r, purpose in ((days, "day"), (minutes, "min"))
        ]
        df = df.withColumn(step.noise, F.array(*pair))
    else:
        df = _lookup_person(
            df, step, lambda d, _: date_noise_table(d, _keys(step), days, minutes), {step.noise: VALUE}
        )
    return _shifted(df, step, F.get(step.noise, F.lit(0)), F.get(step.noise, F.lit(1)) if minutes else None)


def noise(df: DataFrame, step: Step) -> DataFrame:
    """Add an integer drawn per row; with ``seed`` and ``keys`` fixed by the row's key."""
    return df.withColumn(
        step.output, step.expr(step.config["origin"]) + _row_noise(step, step.config["range"], "value")
    )


def noise_date(df: DataFrame, step: Step) -> DataFrame:
    """Shift a date or timestamp by days and minutes drawn per row."""
    days, minutes = step.config.get("range_day"), step.config.get("range_minute")
    by_days = _row_noise(step, days, "day") if days else F.lit(0)
    return _shifted(df, step, by_days, _row_noise(step, minutes, "min") if minutes else None)


def _shifted(df: DataFrame, step: Step, days: Column, minutes: Column | None) -> DataFrame:
    origin = step.expr(step.config["origin"])
    is_date = isinstance(df.select(origin.alias("o")).schema["o"].dataType, DateType)
    if is_date and minutes is None:
        return df.withColumn(step.output, F.date_add(origin, days.cast("int")))
    if is_date:
        origin = origin.cast("timestamp")
    interval = F.make_dt_interval(
        days=days.cast("int"), mins=F.lit(0) if minutes is None else minutes.cast("int")
    )
    return df.withColumn(step.output, origin + interval)


def _row_noise(step: Step, bounds: Sequence[int], purpose: str) -> Column:
    if step.config.get("seed") is None:
        return random_between(*bounds)
    keys = as_list(step.config.get("keys"))
    if not keys:
        raise ValueError("seeded row noise needs 'keys' that identify a row")
    return keyed_between(*bounds, step.config["seed"], purpose, *[step.expr(k) for k in keys])


def _is_keyed(step: Step) -> bool:
    # a given directory asks for a kept table; a seed alone needs neither table nor join
    return step.config.get("seed") is not None and not step.config.get("directory")


def _match(step: Step) -> list[Column]:
    return [step.expr(m) for m in as_list(step.config["match"])]


def _keys(step: Step) -> list[str]:
    """Key columns of the person table: the matched columns' names, or k0.. for expressions."""
    return [step.name(m) or f"k{i}" for i, m in enumerate(as_list(step.config["match"]))]


def _lookup_person(df: DataFrame, step: Step, build: Build, values: dict[str, str]) -> DataFrame:
    match, keys = as_list(step.config["match"]), _keys(step)
    people = step.stats_frame(df, *match).select(*[step.expr(m).alias(k) for m, k in zip(match, keys)])
    directory = step.config.get("directory")
    if directory:
        path = f"{directory}/{step.config['fn']}.{'.'.join(keys)}.parquet"
        table = pseudonym_table(people, keys, build, path, bool(step.config.get("extend")))
    else:
        # numbers rest on a written table already; random values would change when drawn again
        table = build(people, 1)
        table = table if step.config["fn"] == "person_counter" else keep(table, "pseudonyms")
    return lookup(df, table, _match(step), keys, values)
