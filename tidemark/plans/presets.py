"""Column lists of the call-centre model: interaction fact and employee dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators import scd2
from tidemark.operators.scd2 import VersionSpec
from tidemark.plans.fact import FactSpec
from tidemark.sources.rows import local_frame

# Key of interaction tables.
INTERACTION_KEY = ("InteractionIDKey", "SiteID", "SeqNo")

# Interaction columns taken over under their own name, in fact order.
INTERACTION_COLUMNS = (
    "InteractionIDKey", "SiteID", "SeqNo", "AccountCode", "Direction", "ConnectionType", "MediaType", "DNIS",
    "StartDTOffset", "InitiatedDateTimeUTC", "ConnectedDateTimeUTC", "TerminatedDateTimeUTC", "LastLocalUserId",
    "LastAssignedWorkgroupID", "RemoteName", "FirstAssignedAcdSkillSet", "tDialing", "tIVRWait", "QueueWait",
    "tAlert", "tConnected", "tHeld", "tConference", "tExternal", "tACW", "nIVR", "nQueueWait", "nTalk",
    "nConference", "nHeld", "nTransfer", "nExternal",
)

# Fact columns that have another name in the source.
INTERACTION_RENAMES = {"DNIS": "DNIS_LocalID", "QueueWait": "tQueueWait"}

# Custom attributes joined to the interaction.
CUSTOM_COLUMNS = (
    "CustomNum1", "CustomNum2", "CustomNum3", "CustomNum4", "CustomString1", "CustomString2", "CustomString3",
    "CustomString4",
)

# System columns the fact keeps, and their names there.
RECORD_COLUMNS = {
    "RecordCreatedDateTimeUTC": "__record_created_datetime_utc",
    "RecordCreatedDateTimeCST": "__record_created_datetime_cst",
    "__PartitionDateUTC": "__PartitionDateUTC",
}

INTERACTION_FACT = FactSpec(
    keys=INTERACTION_KEY,
    base={c: INTERACTION_RENAMES.get(c, c) for c in INTERACTION_COLUMNS} | RECORD_COLUMNS,
    attributes={c: c for c in CUSTOM_COLUMNS},
    matched="callId",
    fact_id="Fact_InteractionID",
    hash_key="InteractionHashKey",
    order=(
        "Fact_InteractionID",
        "InteractionHashKey",
        *INTERACTION_COLUMNS,
        "callId",
        *CUSTOM_COLUMNS,
        *RECORD_COLUMNS,
    ),
)
# Columns on which the fact is merged.
INTERACTION_FACT_KEY = ("Fact_InteractionID", *INTERACTION_KEY)

# Employee attributes that make up the row hash, in hash order.
EMPLOYEE_TRACKED = (
    "EmployeeID", "FullEmployeeID", "EmployeeName", "Company", "HireDate", "JobTitle", "FullName", "FirstName",
    "MiddleName", "LastName", "FullPartTIme", "Status", "OrgLevel1Code", "OrgLevel2", "SupervisorID",
    "SupervisorName", "UserName", "LastDayWorked", "TerminationDate", "TerminationReason", "Location", "Project",
    "CICUserID",
)
# Employee attributes whose gaps are filled from earlier rows.
EMPLOYEE_FILLED = ("CICUserID", "UserName", "Company", "OrgLevel1Code", "OrgLevel2")
EMPLOYEE_RENAMES = {"FullPartTIme": "EmploymentType"}

# The employee dimension's columns and types.
EMPLOYEE_DDL = """
Dim_EmployeeID bigint, EmployeeID int, FullEmployeeID string, EmployeeName string, Company string, HireDate date,
JobTitle string, FullName string, FirstName string, MiddleName string, LastName string, EmploymentType string,
Status string, OrgLevel1Code string, OrgLevel2 string, SupervisorID int, SupervisorName string, UserName string,
LastDayWorked date, TerminationDate date, TerminationReason string, Location string, Project string, CICUserID string,
EffectiveStartDate date, EffectiveEndDate date, RowHashKey string
"""

EMPLOYEE_DIM = VersionSpec(
    entity="EmployeeID",
    order="LoadDate",
    tracked=EMPLOYEE_TRACKED,
    filled=EMPLOYEE_FILLED,
    surrogate="Dim_EmployeeID",
)


def employee_schema() -> T.StructType:
    return T.StructType.fromDDL(EMPLOYEE_DDL)


def employee_seed(spark: SparkSession, company: str = "none", code: str = "none") -> DataFrame:
    """The row a new employee dimension starts with; facts without an employee can point at it."""
    # The stored seed row.
    seed = {
        "Dim_EmployeeID": 99990101,
        "EmployeeID": -1,
        "FullEmployeeID": code,
        "EmployeeName": "test",
        "Company": company,
        "HireDate": date(1, 1, 1),
        "JobTitle": "null",
        "FullName": "null",
        "FirstName": "null",
        "MiddleName": "null",
        "LastName": "null",
        "EmploymentType": "null",
        "Status": "null",
        "OrgLevel1Code": "null",
        "OrgLevel2": "null",
        "SupervisorID": 1234,
        "SupervisorName": "null",
        "UserName": "null",
        "LastDayWorked": date(9999, 12, 31),
        "TerminationDate": date(1, 1, 1),
        "TerminationReason": "none",
        "Location": "NY",
        "Project": "null",
        "CICUserID": "s000",
        "EffectiveStartDate": date(1, 1, 1),
        "EffectiveEndDate": date(9999, 12, 31),
        "RowHashKey": "a9a433af4c2cc502",
    }
    return local_frame(spark, [tuple(seed[name] for name in employee_schema().names)], employee_schema())


def employee_layout(versions: DataFrame) -> DataFrame:
    """Versions in the stored layout."""
    return scd2.finish(versions, employee_schema().names, EMPLOYEE_RENAMES)


def employee_versions(history: DataFrame, spec: VersionSpec = EMPLOYEE_DIM) -> DataFrame:
    """Employee snapshots -> dimension rows in the stored layout."""
    return employee_layout(scd2.versions(history.select(*EMPLOYEE_TRACKED, spec.order), spec))
