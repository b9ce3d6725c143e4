"""Multi-hot drugs, one-hot categories and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.functions.ranking import numbered
from daypanel.session import staged
from daypanel.sources.schemas import CATEGORIES, KEYS, SIGNAL_ORDER, STATIC_NUMBERS


def drug_positions(vocabulary: DataFrame) -> DataFrame:
    """Vocabulary drug -> its place in name order, from 0. The vocabulary is a top-N list, so one row holds it all."""
    names = vocabulary.agg(F.sort_array(F.collect_list("drug")).alias("names"))
    return names.select(F.posexplode("names").alias("position", "drug"))


def drug_sets(use: DataFrame, positions: DataFrame) -> DataFrame:
    """Per (admission, day) the sorted vocabulary positions of its drugs.

    This is the multi-hot vector with only its ones written down. It stays in this form through joins and sequences; a
    set has at most as many members as the vocabulary. Rows without admission or day belong to no set.
    """
    return (
        use.dropna(subset=KEYS)
        .join(positions, "drug")
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_set("position")).alias("drugs"))
    )


def multi_hot(positions: Column, width: int) -> Column:
    """A set of positions as a vector of 0 and 1."""
    places = F.sequence(F.lit(0), F.lit(width - 1))
    return F.transform(places, lambda place: F.array_contains(positions, place).cast("int"))


def category_dictionary(df: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """attribute (its number among the columns), category, place: every distinct non-null value, in order, from place 0.

    Values are made distinct and numbered in ranges, so there is no limit to them and the driver sees none. Stored, since
    all encodings join it.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(k).alias("attribute"), F.col(c).alias("category")) for k, c in enumerate(columns)]))
    values = df.select(pairs).filter(F.col("category").isNotNull()).distinct()
    places = numbered(values, ["attribute", "category"])
    return staged(places.select("attribute", "category", F.col("place").cast("int").alias("place")), "categories")


def _place_of(column: str) -> str:
    return f"_place_{column}"


def with_places(rows: DataFrame, dictionary: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """``rows`` with the place of every category, null for a null or unknown one, as ``_place_...``.

    One join per attribute, left to size-based planning: a broadcast for the few values there are as a rule, and beyond
    that an exchange which the adaptive join splits where a value is frequent.
    """
    for k, column in enumerate(columns):
        known = dictionary.filter(F.col("attribute") == k).select(
            F.col("category").alias(column), F.col("place").alias(_place_of(column))
        )
        rows = rows.join(known, column, "left")
    return rows


def one_hot_bits(dictionary: DataFrame, columns: Sequence[str] = CATEGORIES) -> list[Column]:
    """For rows with places: the one-hot vector of each attribute as a text of 0 and 1, a null giving zeros everywhere."""
    sizes = dictionary.groupBy("attribute").agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("place").alias("first"))
    out = []
    for k, column in enumerate(columns):
        mine = sizes.filter(F.col("attribute") == k)
        n = F.coalesce(mine.select("n").scalar(), F.lit(0))
        at = F.col(_place_of(column)) - mine.select("first").scalar()
        hot = F.concat(F.repeat(F.lit("0"), at), F.lit("1"), F.repeat(F.lit("0"), n - at - 1))
        out.append(F.when(at.isNull(), F.repeat(F.lit("0"), n)).otherwise(hot))
    return out


@dataclass(frozen=True)
class FeatureLayout:
    """Which feature stands at which place of the vector. The drugs are kept apart, as positions.

    Signals and numbers come first; the categories follow at the places of their dictionary.
    """

    dictionary: DataFrame
    signals: Sequence[str] = tuple(SIGNAL_ORDER)
    numbers: Sequence[str] = tuple(STATIC_NUMBERS)
    columns: Sequence[str] = tuple(CATEGORIES)

    @cached_property
    def n_categories(self) -> int:
        """Places of the dictionary in use. Counts its stored rows."""
        return self.dictionary.count() if self.columns else 0

    @property
    def n_features(self) -> int:
        return len(self.signals) + len(self.numbers) + self.n_categories

    @cached_property
    def names(self) -> list[str]:
        """One name per place, for the header of an exchange file. Reads the dictionary, one name a value, to the driver."""
        flat = [*self.signals, *self.numbers]
        if not self.columns:
            return flat
        return flat + [f"{self.columns[row.attribute]}_{row.category}" for row in self.dictionary.orderBy("place").collect()]

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with what ``vector`` and ``n_set`` need."""
        return with_places(rows, self.dictionary, self.columns)

    def _flat(self) -> Column:
        return F.array(*[F.col(name).cast("double") for name in [*self.signals, *self.numbers]]).cast("array<double>")

    def category_places(self) -> Column:
        """The places of a row's categories, in order: its one-hot vector with only the ones written down."""
        return F.array_compact(F.array(*[F.col(_place_of(c)) for c in self.columns])).cast("array<int>")

    def vector(self) -> Column:
        zeros = F.array_repeat(F.lit(0.0), self.n_categories)
        places = self.category_places()
        hot = F.transform(zeros, lambda _, place: F.array_contains(places, place).cast("double"))
        return F.concat(self._flat(), hot)

    def n_set(self) -> Column:
        """Features of a row that are known and not 0."""
        return (F.size(F.filter(self._flat(), lambda v: v != 0)) + F.size(self.category_places())).cast("bigint")

    def without(self, *groups: str) -> FeatureLayout:
        """Leave out feature groups: ``signals``, ``statics`` (numbers and categories) or ``outcome``."""
        numbers = () if "statics" in groups else self.numbers
        if "outcome" in groups:
            numbers = tuple(name for name in numbers if name != "hospital_expire_flag")
        return replace(
            self,
            signals=() if "signals" in groups else self.signals,
            numbers=numbers,
            columns=() if "statics" in groups else self.columns,
        )


def feature_matrix(dataset: DataFrame, layout: FeatureLayout) -> DataFrame:
    """Keys and the feature vector; signals may still be missing in it."""
    return layout.placed(dataset).select(*KEYS, layout.vector().alias("features"))


def flat_frame(rows: DataFrame, layout: FeatureLayout, drugs: Sequence[str] = ()) -> DataFrame:
    """The exchange form of a matrix: one named column per feature, drugs first when they are given in name order.

    Column order: admission, day, one 0/1 column per drug, signals, static numbers, one 0/1 column per category value.
    """
    hot = [
        F.array_contains("drugs", F.lit(place)).cast("int").alias(f"drug_{name}") for place, name in enumerate(drugs)
    ]
    cells = [F.col("features")[place].alias(name) for place, name in enumerate(layout.names)]
    return rows.select(*KEYS, *hot, *cells)


def with_drugs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Attach the day's drugs by key. Both sides have one row per (admission, day)."""
    return rows.join(sets, KEYS)


def null_counts(columns: Sequence[str]) -> dict[str, Column]:
    """The aggregates of the null audit, one a column."""
    return {name: F.count_if(F.col(name).isNull()) for name in columns}


def null_audit(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per column, one row each, from a single aggregate."""
    counts = dataset.agg(*[n.alias(name) for name, n in null_counts(columns).items()])
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("n_null")) for name in columns]
    return counts.select(F.inline(F.array(*pairs)))
