from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regstat import catalogue as cat  # noqa: E402
from regstat.session import local_session  # noqa: E402
from regstat.sources.readers import Sources  # noqa: E402
from regstat.sources.schemas import CODES, PERSONS, PLACES, RESIDENCE, STAYS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="regstat-tests")
    yield s


def D(s: str | None):
    return None if s is None else dt.date.fromisoformat(s)


def make_sources(
    spark,
    codes=(),
    stays=(),
    persons=(),
    residence=(),
    places=(),
) -> Sources:
    """Sources from literal rows. ``codes`` and ``stays`` rows start with the
    service name; the rest follow the schemas in ``regstat.sources.schemas``."""

    def svc_df(rows, schema):
        df = spark.createDataFrame(list(rows), "service string, " + schema.simpleString()[7:-1].replace(":", " "))
        return {s.name: df.filter(df.service == s.name).drop("service") for s in cat.SERVICES}

    def df(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return Sources(
        codes=svc_df(codes, CODES),
        stays=svc_df(stays, STAYS),
        persons=df(persons, PERSONS),
        residence=df(residence, RESIDENCE),
        places=df(places, PLACES),
    )


def code(service, key, year, value, code_type=6, code_no=11, axis=1, condition=1):
    return (service, key, year, code_type, code_no, axis, condition, value)


def stay(service, key, year, pid, sex=None, home="0301", care=1, rehab=0, niva="A"):
    return (service, key, year, pid, sex, home, care, rehab, niva)
