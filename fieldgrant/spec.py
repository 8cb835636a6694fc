"""Declarative dataset specs and the silver contract."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from .functions.amounts import comma_amount, plain_amount
from .functions.names import misread_as_latin1, quoted

# The silver contract (names, order and types).
TEXT_COLUMNS = ("beneficiary", "municipality", "country", "year", "intervention_code")
AMOUNT_COLUMNS = ("total_eagf_income_support", "total_eafrd_income_support", "national_cofunding_amount")
AUDIT_COLUMN = "silver_created_at"
SILVER_SCHEMA = StructType(
    [StructField(c, StringType()) for c in TEXT_COLUMNS]
    + [StructField(c, DoubleType()) for c in AMOUNT_COLUMNS]
    + [StructField(AUDIT_COLUMN, TimestampType())]
)
SILVER_GRAIN = ("beneficiary", "intervention_code", "municipality")
UNKNOWN_TEXT = "UNKNOWN"

# Columns every bronze table carries besides its own.
PROVENANCE_COLUMNS = {
    "source_country": StringType(),
    "source_year": StringType(),
    "ingested_at": TimestampType(),
}

Parser = Callable[[str], Column]
Preparation = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FieldSpec:
    """``target`` is read from ``source`` (or the first alias present) through ``parse``."""

    target: str
    source: str
    parse: Parser | None = None
    aliases: tuple[str, ...] = ()

    def present_source(self, available: list[str]) -> str:
        return next((c for c in (self.source, *self.aliases) if c in available), self.source)

    def expression(self, available: list[str]) -> Column:
        name = self.present_source(available)
        value = F.col(quoted(name)) if self.parse is None else self.parse(name)
        return value.alias(self.target)


@dataclass(frozen=True)
class DatasetSpec:
    """How one dataset becomes silver: preparation of the raw frame, then a mapping of its columns."""

    country: str
    year: str
    fields: tuple[FieldSpec, ...]
    grain: tuple[str, ...] = SILVER_GRAIN
    prepare: Preparation | None = None

    @property
    def dataset_id(self) -> str:
        return f"{self.country}_{self.year}"

    def with_fields(self, *extra: FieldSpec) -> DatasetSpec:
        """The same dataset with further columns kept (they come after the mapped ones)."""
        return replace(self, fields=self.fields + extra)


    def contract(self, found: StructType) -> StructType:
        """The silver contract, widened by the columns of this spec that it doesn't have, of the types found."""
        extra = [f.target for f in self.fields if f.target not in SILVER_SCHEMA.names]
        return StructType(SILVER_SCHEMA.fields + [found[c] for c in extra])


def payment_fields(
    beneficiary: str, municipality: str, code: str, eagf: str, eafrd: str, cofunding: str, parse: Parser
) -> tuple[FieldSpec, ...]:
    """The eight mapped silver columns. A name with non-ASCII letters is also accepted in the
    form it takes when the UTF-8 file was decoded as ISO-8859-1."""

    def field(target: str, source: str, how: Parser | None = None) -> FieldSpec:
        misread = misread_as_latin1(source)
        return FieldSpec(target, source, how, () if source.isascii() else (misread,))

    return (
        field("beneficiary", beneficiary),
        field("municipality", municipality),
        field("country", "source_country"),
        field("year", "source_year"),
        field("intervention_code", code),
        field("total_eagf_income_support", eagf, parse),
        field("total_eafrd_income_support", eafrd, parse),
        field("national_cofunding_amount", cofunding, parse),
    )


def _title_row_preparation(anchor: str) -> Preparation:
    def prepare(df: DataFrame) -> DataFrame:
        from .operators.shape import promote_header

        return promote_header(df, anchor)

    return prepare


def _shift_preparation(date: str, amount: str) -> Preparation:
    """Amounts that slipped into the date column go back; without such a column nothing is to be done."""

    def prepare(df: DataFrame) -> DataFrame:
        from .operators.repair import repair_shift

        present = next((c for c in (date, misread_as_latin1(date)) if c in df.columns), None)
        return df if present is None else repair_shift(df, present, amount)

    return prepare


# Source columns of the six published datasets.
_SPAIN = payment_fields(
    beneficiary="beneficiario",
    municipality="municipio",
    code="medida",
    eagf="feaga",
    eafrd="feader",
    cofunding="importecofin",
    parse=comma_amount,
)
_IRELAND_2023 = payment_fields(
    beneficiary="name_of_the_beneficiary_legal_entity_association",
    municipality="municipality",
    code="code_of_measure_type_of_intervention_sector_as_set_in_annex_ix",
    eagf="amount_by_operation_under_eagf",
    eafrd="amount_by_operation_under_eafrd",
    cofunding="amount_by_operation_under_co_financing",
    parse=plain_amount,
)
_IRELAND_2024 = payment_fields(
    beneficiary="Name of the beneficiary/Legal entity/association",
    municipality="Municipality",
    code="Code of measure type of intervention/sector as set in Annex IX",
    eagf="Amount by operation under EAGF",
    eafrd="Amount by operation under EAFRD",
    cofunding="Amount by operation under co-financing",
    parse=plain_amount,
)
_GERMANY = payment_fields(
    beneficiary="name_des_begünstigten_rechtsträgers_verdands",
    municipality="gemeinde",
    code="code_der_maßnahme_der_interventionskategorie_des_sektors_gemäß_anhang_ix",
    eagf="betrag_je_vorhaben_im_rahmen_des_egfl",
    eafrd="betrag_je_vorhaben_im_rahmen_des_eler_(eu_mittel)",
    cofunding="betrag_je_vorhaben_im_rahmen_der_nationalen_kofinanzierung",
    parse=plain_amount,
)

DATASETS = {
    spec.dataset_id: spec
    for spec in (
        DatasetSpec("SPAIN", "2023", _SPAIN),
        DatasetSpec("SPAIN", "2024", _SPAIN),
        DatasetSpec("IRELAND", "2023", _IRELAND_2023, prepare=_shift_preparation("end_date_³", _IRELAND_2023[5].source)),
        DatasetSpec("IRELAND", "2024", _IRELAND_2024, prepare=_title_row_preparation(_IRELAND_2024[0].source)),
        DatasetSpec("GERMANY", "2023", _GERMANY),
        DatasetSpec("GERMANY", "2024", _GERMANY),
    )
}
