"""A synthetic table of persons, derived row by row from a sequence number."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The syllables names are made of, family name first, one for each digit.
FAMILY_SYLLABLES = "ban cor del fim gol hur jas kel lom nuv".split()
GIVEN_SYLLABLES = "a be ci do eu fa gi ho iu la".split()
# First birthday, genders, income per sequence number.
FIRST_BIRTHDAY = datetime.date(1945, 8, 15)
GENDERS = ("F", "M")
INCOME_STEP = 1000


def synthetic_people(spark: SparkSession, rows: int = 100_000, as_of: datetime.date | None = None) -> DataFrame:
    return add_person_columns(spark.range(rows).withColumnRenamed("id", "sid"), "sid", as_of)


def add_person_columns(df: DataFrame, sid: str = "sid", as_of: datetime.date | None = None) -> DataFrame:
    """Add name, birthday, two later dates, gender and income for a non-negative sequence number.

    Birthdays cycle through all days up to ``as_of``, today unless given.
    """
    days = ((as_of or datetime.date.today()) - FIRST_BIRTHDAY).days + 1
    number = F.col(sid)
    hundreds, tens, ones = (F.floor(number / unit) % 10 for unit in (100, 10, 1))
    birthday = F.date_add(F.lit(FIRST_BIRTHDAY), F.pmod(number, F.lit(days)).cast("int"))
    return df.withColumns(
        {
            "name": F.concat(
                _pick(FAMILY_SYLLABLES, hundreds), _pick(GIVEN_SYLLABLES, tens), _pick(GIVEN_SYLLABLES, ones)
            ),
            "birthday": birthday,
            "date1": F.add_months(birthday, 120),
            "date2": F.date_add(F.add_months(birthday, 120), 10),
            "gender": _pick(GENDERS, F.pmod(number, F.lit(len(GENDERS)))),
            "income": number.cast("long") * INCOME_STEP,
        }
    )


def _pick(choices, index: Column) -> Column:
    return F.get(F.array(*map(F.lit, choices)), index.cast("int"))
