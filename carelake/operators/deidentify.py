"""De-identification of a flat clinical table by a declared policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import deid
from carelake.schemas import require_columns


@dataclass(frozen=True)
class DeidPolicy:
    """What happens to which column.

    tokens: source -> output; shifts: output -> (date, person); redactions:
    source -> output; ages: source -> output, top-coded; drop: columns removed in any
    case, names among them. `salted_shifts` salts the date shift too: without it anyone
    who knows a patient id can undo the shift.
    """

    tokens: Mapping[str, str] = field(default_factory=dict)
    shifts: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    redactions: Mapping[str, str] = field(default_factory=dict)
    ages: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()
    salted_shifts: bool = False
    rules: Sequence[tuple[str, str]] = (deid.SSN_RULE,)
    token_hex_digits: int = deid.TOKEN_HEX_DIGITS

    def sources(self) -> list[str]:
        shifted = [c for pair in self.shifts.values() for c in pair]
        return list(dict.fromkeys([*self.tokens, *shifted, *self.redactions, *self.ages]))


CLINICAL_POLICY = DeidPolicy(
    tokens={"patient_ssn": "patient_ssn_deid", "patient_mrn": "patient_mrn_deid"},
    shifts={"admission_date_shifted": ("admission_date", "patient_id")},
    redactions={"clinical_notes": "clinical_notes_redacted"},
    drop=("patient_ssn", "patient_mrn", "admission_date"),
)

# Both move a patient's dates by the same days and give the patient the same token.
STAY_POLICY = DeidPolicy(
    tokens={"patient_mrn": "patient_mrn_deid"},
    shifts={
        "admission_date_shifted": ("admission_date", "patient_id"),
        "discharge_date_shifted": ("discharge_date", "patient_id"),
    },
)
TEST_POLICY = DeidPolicy(
    tokens={"patient_mrn": "patient_mrn_deid"}, shifts={"taken_on_shifted": ("taken_on", "patient_id")},
)


def deidentify(
    df: DataFrame, policy: DeidPolicy, salt: str, drop_source: bool = True, strict: bool = True
) -> DataFrame:
    """Add the de-identified columns and drop the identifying ones, in one projection.

    With `drop_source` every column the policy reads is dropped, free text and
    patient id too; without it only `policy.drop`. Not `strict` skips rules whose
    columns are absent instead of failing.
    """
    if strict:
        require_columns(df, policy.sources(), "deidentify")
    have = set(df.columns)
    added = [
        deid.token(F.col(c), salt, policy.token_hex_digits).alias(out)
        for c, out in policy.tokens.items() if c in have
    ]
    added += [
        deid.shifted_date(F.col(date), F.col(person), salt if policy.salted_shifts else "").alias(out)
        for out, (date, person) in policy.shifts.items() if {date, person} <= have
    ]
    added += [
        deid.redacted(F.col(c), policy.rules).alias(out)
        for c, out in policy.redactions.items() if c in have
    ]
    added += [deid.top_coded_age(F.col(c)).alias(out) for c, out in policy.ages.items() if c in have]
    dropped = set(policy.drop) | (set(policy.sources()) if drop_source else set())
    return df.select(*[c for c in df.columns if c not in dropped], *added)
