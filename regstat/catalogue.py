"""Service specs, diagnosis groups and output headers.

Everything here is *data*: the five services run the same operators with
different parameters, and the diagnosis groups are unions of string prefix
ranges. Operators build Spark ``Column`` expressions from these objects.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PrefixRange:
    """``lo <= left(code, width) <= hi`` under binary string order."""

    width: int
    lo: str
    hi: str


@dataclass(frozen=True)
class PrefixSet:
    """``left(code, width) IN values``."""

    width: int
    values: tuple[str, ...]


@dataclass(frozen=True)
class CodeGroup:
    """A diagnosis group: a code row is in the group if any rule matches."""

    name: str
    rules: tuple[PrefixRange | PrefixSet, ...]


@dataclass(frozen=True)
class MainDiagnosis:
    """Selector for main-diagnosis code rows.

    ``kind == "type"``: ``code_type == code_type AND code_no IN code_nos``.
    ``kind == "axis"``: ``axis == axis AND condition == condition``.
    """

    kind: str
    code_type: int | None = None
    code_nos: tuple[int, ...] = ()
    axis: int | None = None
    condition: int | None = None


@dataclass(frozen=True)
class ServiceSpec:
    name: str  # id used in episode ids and the ``service`` column
    label: str  # name on delivered tables and the control table
    selector: MainDiagnosis
    groups: tuple[CodeGroup, ...]
    somatic_stay_filter: bool = False  # rehab NULL/0 and level <> 'S'

    @property
    def group_names(self) -> list[str]:
        return [g.name for g in self.groups]


# ---------------------------------------------------------------------------
# Fixed values. These must equal the delivered statistics' definitions.
# ---------------------------------------------------------------------------

START_YEAR = 2012
END_YEAR = 2025

CARE_LEVELS = (1, 2)  # day and inpatient treatment only
MAX_ID_LENGTH = 12  # a valid person id is shorter than this

SEX_MEN = "Menn"
SEX_WOMEN = "Kvinner"
SEX_UNKNOWN = "Uoppgitt"
SEX_CODES = {"1": SEX_MEN, "2": SEX_WOMEN}

REHAB_KEEP = 0  # is_rehab NULL or 0 is kept (somatic only)
LEVEL_EXCLUDED = "S"  # niva 'S' is dropped (somatic only)

MUNICIPALITY_SENTINELS = ("9999", "")  # become NULL before the fallback
MUNICIPALITY_WIDTH = 4
MUNICIPALITY_PATTERN = "^[0-9]{4}$"

# place override: (code, current code, current name)
PLACE_OVERRIDES = (("1534", "1580", "Haram"),)

SOMATIC_GROUPS = (
    CodeGroup("I00_I99", (PrefixRange(3, "I00", "I99"),)),
    CodeGroup("I21_I22", (PrefixRange(3, "I21", "I22"),)),
    CodeGroup("J44", (PrefixSet(3, ("J44",)),)),
    CodeGroup("M00_M99", (PrefixRange(3, "M00", "M99"),)),
    CodeGroup("S00_T78", (PrefixRange(3, "S00", "T78"),)),
    CodeGroup("S720_S729", (PrefixRange(4, "S720", "S729"),)),
    CodeGroup("S720_S722", (PrefixRange(4, "S720", "S722"),)),
    CodeGroup("T36_T65", (PrefixRange(3, "T36", "T65"),)),
    CodeGroup("S00_S09", (PrefixRange(3, "S00", "S09"),)),
)

PSYCHIATRIC_GROUPS = (
    CodeGroup("F00_F99", (PrefixRange(3, "F00", "F99"),)),
    CodeGroup("F30_F39", (PrefixRange(3, "F30", "F39"),)),
    CodeGroup("F40_F48", (PrefixRange(3, "F40", "F48"),)),
    CodeGroup(
        "F10_F16_F18_F19",
        (PrefixRange(3, "F10", "F16"), PrefixSet(3, ("F18", "F19"))),
    ),
    CodeGroup("F10", (PrefixSet(3, ("F10",)),)),
    CodeGroup(
        "F11_F16_F18_F19",
        (PrefixRange(3, "F11", "F16"), PrefixSet(3, ("F18", "F19"))),
    ),
)

MAIN_BY_TYPE = MainDiagnosis(kind="type", code_type=6, code_nos=(11, 12))
MAIN_BY_AXIS = MainDiagnosis(kind="axis", axis=1, condition=1)

SERVICES = (
    ServiceSpec("SOM", "SOM", MAIN_BY_TYPE, SOMATIC_GROUPS, somatic_stay_filter=True),
    ServiceSpec("PHV", "PHV", MAIN_BY_TYPE, PSYCHIATRIC_GROUPS),
    ServiceSpec("TSB", "TSB", MAIN_BY_TYPE, PSYCHIATRIC_GROUPS),
    ServiceSpec("PHBU", "PHBU", MAIN_BY_AXIS, PSYCHIATRIC_GROUPS),
    ServiceSpec("AVT", "AVTPHV", MAIN_BY_TYPE, PSYCHIATRIC_GROUPS),
)

# Delivered profile tables: key columns in order, with their headers.
PROFILE_KEY_HEADERS = (
    ("year", "Ar"),
    ("municipality", "Bostedskommune"),
    ("kommunenavn", "Kommunenavn"),
    ("kommunenrdagens", "DagensKommunenr"),
    ("kommunenavndagens", "DagensKommunenavn"),
    ("fylkenr", "Fylkenr"),
    ("fylkenavn", "Fylkenavn"),
    ("fylkenrdagens", "DagensFylkenr"),
    ("fylkenavndagens", "DagensFylkenavn"),
    ("sex", "Kjonn"),
    ("age", "Alder"),
)

# Care-level precheck: status labels (values in the delivered table).
STATUS_IN_EXTRACT = "Med i uttrekk"
STATUS_NOT_IN_EXTRACT = "Ikke med i uttrekk"

# Delivered control table and precheck: column -> header.
CONTROL_HEADERS = (
    ("service", "Tjeneste"),
    ("extract_rows", "Rader_i_SQL_uttrekk"),
    ("extract_persons", "Unike_personer_i_SQL_uttrekk"),
    ("rows_care_level_1", "Rader_omsorgsniva_1"),
    ("rows_care_level_2", "Rader_omsorgsniva_2"),
    ("rows_with_residence", "Rader_etter_bosted"),
    ("output_rows", "Rader_i_output"),
    ("min_year", "Min_ar_output"),
    ("max_year", "Max_ar_output"),
)
PRECHECK_HEADERS = (
    ("care_level", "omsorgsniva"),
    ("status", "filterstatus"),
    ("n_code_rows", "n_koderader"),
    ("n_stays", "n_opphold"),
    ("n_persons", "n_pasienter"),
)

# Delivered table names (one per sheet of the delivery).
CONTROL_TABLE_NAME = "Kontroll"
PRECHECK_TABLE_NAME = "AVT_omsorgsniva"

# Place dimension columns (all strings after load); the first is the key.
PLACE_COLUMNS = (
    "kommunenr",
    "kommunenavn",
    "kommunenrdagens",
    "kommunenavndagens",
    "fylkenr",
    "fylkenavn",
    "fylkenrdagens",
    "fylkenavndagens",
)

# Register tables of each service: codes, stays, and the stay key's name in both.
SERVICE_TABLES = {
    "SOM": ("SOMKoder", "SOMHoved", "som_k"),
    "PHV": ("PHVKoder", "PHVHoved", "phv_k"),
    "TSB": ("TSBKoder", "TSBHoved", "phv_k"),
    "PHBU": ("PHBUKoder", "PHBUHoved", "bup_k"),
    "AVT": ("AVTKoder", "AVTHoved", "asp_k"),
}

# The register's column names, by ours; columns not listed share one name.
SOURCE_COLUMNS = {
    "codes": {"year": "aar", "code_type": "KodeType", "code_no": "KodeNr", "axis": "Akse", "condition": "Tilstand", "code": "KodeVerdi"},
    "stays": {
        "year": "aar", "person_id": "NPRId", "sex": "kjonn", "home_municipality": "komnrhjem2",
        "care_level": "omsorgsniva", "is_rehab": "erRehabilitering",
    },
    "persons": {"person_id": "NPRId", "birth_year": "fodtAar", "sex": "kjonn"},
    "residence": {"person_id": "NPRId", "from_date": "fradato", "to_date": "tildato", "municipality": "kommune"},
}

# ---------------------------------------------------------------------------
# Lookups derived from the fixed values above.
# ---------------------------------------------------------------------------

SERVICE_BY_NAME = {s.name: s for s in SERVICES}
ALL_GROUP_NAMES = tuple(dict.fromkeys(g.name for s in SERVICES for g in s.groups))


def service(name: str) -> ServiceSpec:
    try:
        return SERVICE_BY_NAME[name.upper()]
    except KeyError:
        raise KeyError(f"unknown service {name!r}; known: {sorted(SERVICE_BY_NAME)}")


def years(start: int = START_YEAR, end: int = END_YEAR) -> list[int]:
    return list(range(start, end + 1))
