from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deskmetrics.schemas import CHANGES_SCHEMA, ISSUES_SCHEMA, as_text  # noqa: E402
from deskmetrics.session import local_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
CHECK_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="deskmetrics-tests-")
    session = local_session("*", shuffle_partitions=8, scratch=scratch)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scratch_dir(spark):
    from deskmetrics.session import checkpoint_dir
    path = checkpoint_dir(spark)
    return path[len("file:"):] if path.startswith("file:") else path


ISSUE_COLS = [f.name for f in ISSUES_SCHEMA.fields]
CHANGE_COLS = [f.name for f in CHANGES_SCHEMA.fields]


def issue(id, created, resolved=None, priority="High", assignee="a1", reporter="r1",
          proj=" proj ", itype="bug", last_change=None, status="Open"):
    """One raw ticket row (all text, like the CSV extract)."""
    row = dict.fromkeys(ISSUE_COLS)
    row.update(id=str(id), issue_num=str(id), issue_proj=proj, issue_reporter=reporter,
               issue_assignee=assignee, issue_contr_count="1", issue_priority=priority,
               issue_type=itype, issue_created=created, issue_resolution_date=resolved,
               issue_status=status, issue_comments_count="0", last_change_date=last_change,
               wf_total_time="60", processing_steps="1")
    return tuple(row[c] for c in ISSUE_COLS)


def change(id, issueid, field, value, created):
    return (str(id), str(issueid), field, value, created, "1")


def raw_frames(spark, issues, changes):
    return (spark.createDataFrame(issues, as_text(ISSUES_SCHEMA)),
            spark.createDataFrame(changes, as_text(CHANGES_SCHEMA)))


def ts(s: str) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")
