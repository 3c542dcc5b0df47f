"""Column lists and table definitions.

Everything here is data: names, types, which columns are required, how a table
is laid out. Readers, jobs and loaders take their schemas from this module.
"""

from __future__ import annotations

from dataclasses import dataclass


def _columns(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(line.split()) for line in text.strip().splitlines())


def ddl(columns) -> str:
    """Schema string for ``spark.read.schema`` and ``CREATE TABLE``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns)


# Fields of one raw case record. Counts and date parts arrive as text
# or as numbers and are cast by the model. They are read as variants: numbers read
# as text make the parser fetch each of them again from the file.
CASE_RECORD_FIELDS = _columns("""
dateRep string
day variant
month variant
year variant
cases variant
deaths variant
countriesAndTerritories string
geoId string
continentExp string
""")

CASE_DOCUMENT_SCHEMA = (
    "records array<struct<"
    + ",".join(f"{name}:{kind}" for name, kind in CASE_RECORD_FIELDS)
    + ">>"
)

# Columns of the case table, in table order.
CASE_COLUMNS = _columns("""
country string
continent string
geoid string
cases int
deaths int
daterep date
day int
month int
year int
""")

# Columns of the raw flights file, in file order.
FLIGHT_FILE_COLUMNS = _columns("""
fl_date date
op_unique_carrier string
tail_num string
origin_airport_id int
origin_airport_seq_id int
origin_city_market_id int
origin string
origin_city_name string
origin_state_abr string
origin_state_fips string
origin_state_nm string
origin_wac string
dest_airport_id int
dest_airport_seq_id int
dest_city_market_id int
dest string
dest_city_name string
dest_state_abr string
dest_state_fips string
dest_state_nm string
dest_wac string
dep_time string
dep_delay float
dep_delay_new float
dep_del15 float
arr_time string
arr_delay float
arr_delay_new float
arr_del15 float
cancelled float
cancellation_code string
""")

# Flight columns that may be null; all others are required.
FLIGHT_OPTIONAL = frozenset(
    "tail_num dep_time dep_delay dep_delay_new dep_del15 arr_time arr_delay"
    " arr_delay_new arr_del15 cancellation_code".split()
)

# The modelled fact: the flag becomes an int in place, year and month come last.
FLIGHT_COLUMNS = tuple(
    (name, "int" if name == "cancelled" else kind) for name, kind in FLIGHT_FILE_COLUMNS
) + (("year", "int"), ("month", "int"))

LOOKUP_COLUMNS = _columns("""
code string
description string
""")

# Lookup tables and the files they are loaded from.
LOOKUP_FILES = {
    "airport_id": "L_AIRPORT_ID.csv",
    "airport_seq_id": "L_AIRPORT_SEQ_ID.csv",
    "cancellation": "L_CANCELLATION.csv",
    "city_market_id": "L_CITY_MARKET_ID.csv",
    "state_abbreviation": "L_STATE_ABR_AVIATION.csv",
    "world_area_codes": "L_WORLD_AREA_CODES.csv",
    "state_fips": "L_STATE_FIPS.csv",
}

# Which lookup table describes which flight columns.
LOOKUPS_BY_FLIGHT_COLUMN = {
    "origin_airport_id": "airport_id",
    "dest_airport_id": "airport_id",
    "origin_airport_seq_id": "airport_seq_id",
    "dest_airport_seq_id": "airport_seq_id",
    "cancellation_code": "cancellation",
    "origin_city_market_id": "city_market_id",
    "dest_city_market_id": "city_market_id",
    "origin_state_abr": "state_abbreviation",
    "dest_state_abr": "state_abbreviation",
    "origin_wac": "world_area_codes",
    "dest_wac": "world_area_codes",
    "origin_state_fips": "state_fips",
    "dest_state_fips": "state_fips",
}

# Partition columns of the written datasets. They repeat year and month, which
# must also stay inside the files.
MONTH_PARTITIONS = ("_year", "_month")


@dataclass(frozen=True)
class TableSpec:
    """A catalog table.

    ``required`` columns may not be null (enforced by the loader, because Parquet
    tables do not), ``gate`` columns are counted after the load, ``sort_by`` orders
    rows inside each file so that min/max statistics can skip row groups.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    gate: tuple[str, ...] = ()
    label: str = ""

    @property
    def title(self) -> str:
        """The name that messages use: that of readers, for a table of one load."""
        return self.label or self.name

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


# Partition columns are named in table order, which keeps ``select *`` in it.
CASES = TableSpec(
    "covid",
    CASE_COLUMNS,
    partition_by=("month", "year"),
    sort_by=("year", "month", "country"),
    gate=("country", "daterep"),
)

FLIGHTS = TableSpec(
    "flights",
    FLIGHT_COLUMNS,
    partition_by=("year", "month"),
    required=tuple(n for n, _ in FLIGHT_COLUMNS if n not in FLIGHT_OPTIONAL),
    gate=("fl_date", "op_unique_carrier", "origin_airport_id", "dest_airport_id"),
)

LOOKUPS = {name: TableSpec(name, LOOKUP_COLUMNS) for name in LOOKUP_FILES}

TABLES = {CASES.name: CASES, FLIGHTS.name: FLIGHTS, **LOOKUPS}
