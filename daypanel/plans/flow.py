"""The operators composed: from base relations to the modelling table and its sequences."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.operators import encode, impute, panel, sequences, signals, statics, vocabulary
from daypanel.sources.standins import view
from daypanel.sources.tables import read_base, snapshot

VOCABULARY = 400


class BaseRelations:
    """What the flow reads, from the seven base relations. Nothing is opened before it is asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _read(self, name: str) -> DataFrame:
        return read_base(self.spark, self.root, name)

    def marks(self, *names: str) -> dict[str, str]:
        """What tells one state of the stored relations from another."""
        return {name: snapshot(self.spark, f"{self.root}/{name}") for name in names}

    @cached_property
    def admissions(self) -> DataFrame:
        return self._read("admissions")

    @cached_property
    def patients(self) -> DataFrame:
        return self._read("patients")

    @cached_property
    def prescriptions(self) -> DataFrame:
        return self._read("prescriptions")

    @cached_property
    def events(self) -> tuple[DataFrame, DataFrame]:
        """The chart and the lab readings as stored."""
        return self._read("chartevents"), self._read("labevents")

    @cached_property
    def tagged(self) -> DataFrame:
        """Readings with their signal; one scan per event table."""
        chart, lab = self.events
        tagged = signals.tag_signals(chart, "chart", self._read("d_items"))
        return tagged.unionByName(signals.tag_signals(lab, "lab", self._read("d_labitems")))

    @cached_property
    def body(self) -> DataFrame:
        """The readings that height and weight are taken from."""
        return self.events[0]


class EventRelations(BaseRelations):
    """The same relations derived from the event table."""

    def _read(self, name: str) -> DataFrame:
        return view(self.spark, self.root, f"fx_{name}")

    def marks(self, *names: str) -> dict[str, str]:
        return dict.fromkeys(names, snapshot(self.spark, self.root))

    @cached_property
    def tagged(self) -> DataFrame:
        return signals.tag_signals(self._read("readings"), dictionary=self._read("items"))

    @cached_property
    def body(self) -> DataFrame:
        return self._read("body")


class Flow:
    """Lazy stages over the relations; each is one DataFrame, shared by the stages after it."""

    def __init__(
        self,
        relations: BaseRelations,
        n_drugs: int = VOCABULARY,
        stay_days: tuple[int, int] = panel.STAY_DAYS,
        block_rows: int = impute.BLOCK_ROWS,
    ):
        self.relations = relations
        self.n_drugs = n_drugs
        self.stay_days = stay_days
        self.block_rows = block_rows

    @cached_property
    def icu(self) -> DataFrame:
        return vocabulary.icu_prescriptions(self.relations.prescriptions)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return vocabulary.top_drugs(self.icu, self.n_drugs)

    @cached_property
    def use(self) -> DataFrame:
        """Prescriptions of vocabulary drugs, not yet distinct."""
        return vocabulary.in_vocabulary(self.icu, self.vocabulary)

    @cached_property
    def spine(self) -> DataFrame:
        return vocabulary.spine(self.use)

    @cached_property
    def cleaned(self) -> DataFrame:
        return signals.clean_units(self.relations.tagged)

    @cached_property
    def panel(self) -> DataFrame:
        return panel.wide_panel(self.cleaned, self.spine)

    @cached_property
    def static(self) -> DataFrame:
        r = self.relations
        return statics.impute_static(statics.patient_static(r.admissions, r.patients, r.body))

    @cached_property
    def cohort(self) -> DataFrame:
        return statics.with_outcome(statics.adult_cohort(self.static), self.relations.admissions)

    @cached_property
    def keys(self) -> DataFrame:
        return panel.aligned_keys(self.spine, statics.adult_cohort(self.static))

    @cached_property
    def dataset(self) -> DataFrame:
        return panel.modelling_table(self.panel, self.cohort)

    @cached_property
    def stays(self) -> DataFrame:
        return panel.admission_days(self.keys, self.stay_days)

    @cached_property
    def positions(self) -> DataFrame:
        return encode.drug_positions(self.vocabulary)

    @cached_property
    def drug_sets(self) -> DataFrame:
        return encode.drug_sets(self.use, self.positions)

    @cached_property
    def layout(self) -> encode.FeatureLayout:
        """The categories of the admissions in the modelling table become vector places, in a stored dictionary."""
        listed = self.cohort.join(self.spine.select("hadm_id").distinct(), "hadm_id", "left_semi")
        return encode.FeatureLayout(encode.category_dictionary(statics.normalise_categories(listed)))

    @cached_property
    def blocked(self) -> DataFrame:
        matrix = encode.feature_matrix(self.dataset, self.layout)
        return impute.assign_blocks(matrix, self.keys.agg(F.count(F.lit(1))).scalar(), self.block_rows)

    @cached_property
    def imputed(self) -> DataFrame:
        return impute.knn_impute(self.blocked)

    @cached_property
    def matrix(self) -> DataFrame:
        return encode.with_drugs(self.imputed, self.drug_sets)

    @cached_property
    def labelled_days(self) -> DataFrame:
        """Next-day labels without features. Days with drugs are the spine, and ``stays`` are of the cohort already."""
        return sequences.next_day_labels(self.drug_sets, self.stays)

    @cached_property
    def steps(self) -> DataFrame:
        return sequences.next_day_labels(self.matrix, self.stays)

    @cached_property
    def sequences(self) -> DataFrame:
        return sequences.sequences(self.steps)
