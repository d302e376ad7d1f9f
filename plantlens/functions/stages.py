"""Order and category of process stages."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stage -> (position in the flow, category).
STAGES = {
    "thin_film_deposition": (1, "Deposition"),
    "piezoelectric_film_deposition": (1, "Deposition"),
    "sacrificial_layer_deposition": (1, "Deposition"),
    "forming": (1, "Forming"),
    "electrode_and_piezo_deposition": (2, "Deposition"),
    "patterning": (2, "Patterning"),
    "idt_patterning": (2, "Patterning"),
    "sintering": (2, "Thermal Processing"),
    "etching": (3, "Etching"),
    "electrode_etching": (3, "Etching"),
    "via_and_release_etch": (3, "Etching"),
    "cavity_machining": (3, "Machining"),
    "frequency_tuning": (4, "Tuning & Test"),
    "singulation": (4, "Packaging"),
    "packaging": (4, "Packaging"),
    "plating": (4, "Surface Treatment"),
    "final_test": (5, "Final Test"),
    "wafer_level_test": (5, "Final Test"),
    "final_test_and_characterization": (5, "Final Test"),
    "tuning_and_test": (5, "Tuning & Test"),
}
UNKNOWN_STAGE = (99, "Other")


def _lookup(stage: Column, position: int) -> Column:
    entries = chain.from_iterable((F.lit(k), F.lit(v[position])) for k, v in STAGES.items())
    return F.coalesce(F.element_at(F.create_map(*entries), stage), F.lit(UNKNOWN_STAGE[position]))


def stage_sequence(stage: Column) -> Column:
    return _lookup(stage, 0)


def stage_category(stage: Column) -> Column:
    return _lookup(stage, 1)
