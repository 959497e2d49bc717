import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankwise.session import local_session  # noqa: E402

# Contract columns, all nullable so tests can inject nulls.
DETECTIONS_DDL = ("geographical_location_oid long, video_camera_oid long, "
                  "detection_oid long, item_name string, timestamp_detected long")

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8, app="rankwise-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def detections(spark, rows):
    """DataFrame under the detections contract from 5-tuples."""
    return spark.createDataFrame(rows, DETECTIONS_DDL)


def locations(spark, rows):
    return spark.createDataFrame(rows, "geographical_location_oid long, "
                                       "geographical_location string")


def tuples(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_text(df, mode="formatted"):
    """Physical plan as printed by ``explain`` (AQE: the initial plan)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df):
    """The plan tree part of ``explain('simple')``."""
    return plan_text(df, "simple")

