"""Static attributes per admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.functions import limbs
from daypanel.functions.numbers import age_years
from daypanel.operators.registry import HEIGHT_ITEM, WEIGHT_ITEM
from daypanel.sources.schemas import CATEGORIES

ADULT_AGES = (18, 89)

# What stands in for a missing attribute.
DEFAULT_HEIGHT = {"M": 177.0, "F": 169.2}
DEFAULT_CATEGORY = {"religion": "CATHOLIC", "language": "ENGL", "ethnicity": "WHITE"}
BODY_MASS = {"M": 28.3, "F": 26.3}
SINGLE_BELOW = {"M": 31, "F": 28}
SINGLE_FROM = 80

_FEW_DIGITS = r"^[0-9]{1,7}([.][0-9]{0,6})?\z"
_TRIMMED = r"regexp_replace(value, r'[\x00-\x20]+', '')"
_SHIFTED = limbs.pieces(limbs.rounded_units("value", str(2 * limbs.WIDE)))
_LONG_PIECES = (
    f"if(not {limbs.is_number('value')}, null, if(value rlike '[eE]', "
    f"transform({_SHIFTED}, x -> {limbs.limb('x.limb - 2', 'x.piece')}), "
    f"{limbs.pieces(_TRIMMED)}))"
)


def body_measures(chart: DataFrame, strict: bool = False) -> DataFrame:
    """Mean height and weight per admission from one pass over the chart readings, exact for numbers of any length.

    Numbers of few digits, nearly all, are added up as decimals; longer ones limb by limb. An exponent is worked into the
    digits to 30 places behind the point.
    """
    value = F.trim("value")
    short = F.when(value.rlike(_FEW_DIGITS), value.try_cast("decimal(13,6)"))
    if strict:  # the cast of a text that is no number raises
        fine = value.isNull() | F.expr(limbs.is_number("value"))
        short = F.when(fine, short).otherwise(value.cast("decimal(32,6)"))
    cut = F.when(~value.rlike(_FEW_DIGITS), F.expr(_LONG_PIECES))
    tally = (
        chart.filter(F.col("itemid").isin(HEIGHT_ITEM, WEIGHT_ITEM))
        .select("hadm_id", "itemid", short.alias("number"), F.posexplode_outer(cut).alias("at", "cut"))
        .groupBy("hadm_id", "itemid", F.col("cut.limb").alias("limb"))
        .agg(
            F.sum("number").alias("number"),
            (F.count("number") + F.count_if(F.col("at") == 0)).alias("n"),
            F.sum("cut.piece").cast("decimal(38,0)").alias("piece"),
        )
    )

    def sum_of(item: int) -> Column:
        mine = F.col("itemid") == item
        total = F.coalesce(F.sum(F.when(mine, F.col("number"))), F.lit(0).cast("decimal(33,6)"))
        held = F.collect_list(F.when(mine & F.col("limb").isNotNull(), F.struct("limb", "piece")))
        return F.struct(total.alias("total"), held.alias("held"), F.sum(F.when(mine, F.col("n"))).alias("n"))

    def mean(name: str) -> Column:
        both = f"concat({limbs.pieces(f'string({name}.total)')}, {name}.held)"
        total = F.when(F.size(f"{name}.held") == 0, F.col(f"{name}.total").cast("double"))
        total = total.otherwise(F.expr(limbs.total_text(both)).cast("double"))
        return total / F.nullif(F.col(f"{name}.n"), F.lit(0).cast("bigint"))

    sums = tally.groupBy("hadm_id").agg(sum_of(HEIGHT_ITEM).alias("_height"), sum_of(WEIGHT_ITEM).alias("_weight"))
    return sums.select("hadm_id", mean("_height").alias("height"), mean("_weight").alias("weight"))


def admission_body(admissions: DataFrame, chart: DataFrame) -> DataFrame:
    """Every admission with its mean height and weight, null where nothing was measured.

    The readings are averaged before the join, so the join sees one row per admission on both sides.
    """
    return admissions.select("subject_id", "hadm_id").join(body_measures(chart), "hadm_id", "left")


def with_patient(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Admissions with gender and date of birth; a patient may own any number of admissions."""
    return admissions.join(patients.select("subject_id", "gender", "dob"), "subject_id", "left")


def patient_age(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    return with_patient(admissions, patients).select(
        "subject_id", "hadm_id", age_years(F.col("admittime"), F.col("dob")).alias("age")
    )


def patient_static(admissions: DataFrame, patients: DataFrame, chart: DataFrame) -> DataFrame:
    """One row per admission: gender, age, measured body and the four admission categories.

    Admissions carry everything but the body measures, so one lookup per patient and one per admission replace a star
    of five derived tables.
    """
    return (
        with_patient(admissions, patients)
        .join(body_measures(chart), "hadm_id", "left")
        .select(
            "subject_id", "hadm_id", "gender", age_years(F.col("admittime"), F.col("dob")).alias("age"), "weight",
            "height", "religion", "language", "marital_status", "ethnicity",
        )
    )


def impute_static(static: DataFrame) -> DataFrame:
    """Fill missing attributes by rule, and derive the weight of every M and F row from height.

    The order matters: heights first, then weights from them. A measured weight is replaced.
    """
    gender, age = F.col("gender"), F.col("age")
    adult = age.between(*ADULT_AGES)

    height = F.when(F.col("height").isNotNull(), F.col("height"))
    for sex, default in DEFAULT_HEIGHT.items():
        height = height.when((gender == sex) & adult, F.lit(default))
    static = static.withColumn("height", height.otherwise(F.lit(0.0)))

    weight, marital = F.when(F.lit(False), F.lit(0.0)), F.when(
        F.col("marital_status").isNotNull(), F.col("marital_status")
    )
    for sex, mass in BODY_MASS.items():
        weight = weight.when(gender == sex, F.lit(mass) * (F.col("height") / 100) * (F.col("height") / 100))
    for sex, limit in SINGLE_BELOW.items():
        marital = marital.when((gender == sex) & (age < limit), "SINGLE")
    marital = marital.when(age < SINGLE_FROM, "MARRIED").when(age >= SINGLE_FROM, "SINGLE")

    filled = {name: F.coalesce(name, F.lit(default)) for name, default in DEFAULT_CATEGORY.items()}
    return static.withColumns({"weight": weight.otherwise(F.col("weight")), "marital_status": marital, **filled})


def normalise_categories(df: DataFrame) -> DataFrame:
    """Lower case without blanks, for every category column that ``df`` has."""
    present = [name for name in CATEGORIES if name in df.columns]
    return df.withColumns({name: F.replace(F.lower(name), F.lit(" "), F.lit("")) for name in present})


def adult_cohort(static: DataFrame) -> DataFrame:
    """Admissions of ages 18 to 89, both included; an unknown age is not in the cohort."""
    return static.filter(F.col("age").between(*ADULT_AGES))


def with_outcome(cohort: DataFrame, admissions: DataFrame) -> DataFrame:
    """Add the outcome flag of the stay, 0 where the admission is not listed.

    The flag is known only when the stay ends. It is part of the modelling table on purpose; leave it out through the
    feature groups where that is not wanted.
    """
    flags = admissions.select("hadm_id", F.col("hospital_expire_flag").cast("decimal(18,2)").alias("_flag"))
    known = flags.withColumn("_known", F.lit(True))
    flag = F.when(F.col("_known"), F.col("_flag")).otherwise(F.lit(0)).cast("double")
    return (
        cohort.join(known, "hadm_id", "left")
        .withColumn("hospital_expire_flag", flag)
        .drop("_known", "_flag")
    )
