"""Column roles and the fixed values of the request data model.

Every operator addresses columns through a :class:`Roles` instance, so any
request-like table works once its columns are renamed (or the roles pointed at
its names).  The defaults are snake_case role names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source system's conventions for results
# to match: header names of the raw export and the role each one plays, the
# raw date pattern, the placeholder tokens, the status / region sentinels and
# the explicit category spelling fixes.
# ---------------------------------------------------------------------------

SOURCE_HEADER_ROLES: dict[str, str] = {
    "Unique Key": "unique_key",
    "Created Date": "created_date",
    "Closed Date": "closed_date",
    "Agency": "agency",
    "Problem (formerly Complaint Type)": "complaint_type",
    "Status": "status",
    "Borough": "borough",
    "Agency Name": "agency_name",
    "Resolution Action Updated Date": "resolution_updated",
    "Incident Zip": "incident_zip",
    "Taxi Company Borough": "taxi_company_borough",
    "Problem Detail (formerly Descriptor)": "detail",
    "Additional Details": "additional_details",
    "Facility Type": "facility_type",
    "Resolution Description": "resolution_description",
    "Park Facility Name": "park_facility_name",
    "Location Type": "location_type",
    "Road Ramp": "road_ramp",
    "Bridge Highway Segment": "bridge_highway_segment",
    "City": "city",
    "Incident Address": "address",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Location": "location",
}

RAW_DATE_PATTERN = "MM/dd/yyyy hh:mm:ss a"
CLOSED_STATUS = "Closed"
UNSPECIFIED_REGION = "Unspecified"
MISSING_TOKEN = "N/A"
PLACEHOLDER_TOKENS = ("N/A", "NA", "NULL", "None", "NaN")
CATEGORY_SPELLING: dict[str, str] = {"ELEVATOR": "Elevator", "PLUMBING": "Plumbing"}
WEEKEND_DAYS = ("Saturday", "Sunday")
WEEK_ORDER = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Placeholder columns: the first five are profiled, all eight are cleaned.
PROFILED_PLACEHOLDER_COLUMNS = (
    "detail",
    "additional_details",
    "facility_type",
    "resolution_description",
    "park_facility_name",
)
CLEANED_PLACEHOLDER_COLUMNS = PROFILED_PLACEHOLDER_COLUMNS + (
    "location_type",
    "road_ramp",
    "bridge_highway_segment",
)

# Identifier-like columns that must stay text (leading zeros).
IDENTIFIER_COLUMNS = ("incident_zip", "taxi_company_borough")
# Typed columns of the raw export; everything else is read as text.
RAW_NUMERIC_TYPES = {"unique_key": "bigint", "latitude": "double", "longitude": "double"}

DERIVED_FEATURE_COLUMNS = (
    "request_date",
    "request_year",
    "request_month",
    "request_day_of_week",
    "request_hour",
    "resolution_time_hours",
)


def snake_case(name: str) -> str:
    """Role name for a header the mapping does not know."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


@dataclass(frozen=True)
class Roles:
    """Which column plays which part.  Override fields for other tables."""

    key: str = "unique_key"
    created: str = "created_date"
    closed: str = "closed_date"
    resolution_updated: str = "resolution_updated"
    status: str = "status"
    category: str = "complaint_type"
    region: str = "borough"
    handler: str = "agency"
    handler_name: str = "agency_name"
    zip: str = "incident_zip"
    city: str = "city"
    address: str = "address"
    latitude: str = "latitude"
    longitude: str = "longitude"
    location: str = "location"
    invalid_flag: str = "invalid_date_order"
    profiled_placeholders: tuple[str, ...] = PROFILED_PLACEHOLDER_COLUMNS
    cleaned_placeholders: tuple[str, ...] = CLEANED_PLACEHOLDER_COLUMNS
    closed_status: str = CLOSED_STATUS
    unspecified_region: str = UNSPECIFIED_REGION
    extra_required: tuple[str, ...] = field(default=())

    @property
    def required(self) -> tuple[str, ...]:
        """Columns a raw table must have."""
        base = (self.key, self.created, self.closed, self.handler, self.category, self.status, self.region)
        return base + tuple(self.extra_required)

    @property
    def core_fields(self) -> tuple[str, ...]:
        return (self.key, self.created, self.handler, self.category, self.status, self.region)

    @property
    def status_check_columns(self) -> tuple[str, ...]:
        return (self.key, self.created, self.closed, self.handler, self.category, self.status, self.region)

    @property
    def date_columns(self) -> tuple[str, ...]:
        return (self.created, self.closed, self.resolution_updated)

    @property
    def location_columns(self) -> tuple[str, ...]:
        return (self.zip, self.city, self.address, self.latitude, self.longitude, self.location)


DEFAULT_ROLES = Roles()


def present(df_columns, wanted) -> list[str]:
    """``wanted`` in order, restricted to columns the frame has.

    Only for rules that act on whatever optional columns a table has (date
    parsing, placeholder cleaning).  Checks that report on a column use
    :func:`with_optional`, which never drops one.
    """
    have = set(df_columns)
    return [c for c in wanted if c in have]


def with_optional(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with each absent optional column as an all-NULL one (text, or the role's numeric type).

    A required column that is absent is an error, not a NULL column.
    """
    absent = [c for c in columns if c not in df.columns]
    if not absent:
        return df
    return df.withColumns({c: F.lit(None).cast(RAW_NUMERIC_TYPES.get(c, "string")) for c in absent})
