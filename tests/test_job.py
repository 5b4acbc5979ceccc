"""The daily job writes the ten aggregates; each output equals the
standalone query (the shared intermediates change nothing)."""

import tempfile

import __spark_entry__ as E
from flowlens.plans.job import run_daily_job
from flowlens.sources.fixtures import FIXTURE_DAY
from flowlens.sources.rawlogs import read_curated

from .conftest import SMALL

SAME = {"total_internet_egress": "total_internet_egress", "vpc_top_ports_agg": "vpc_top_ports",
        "top_domain_port_geo": "top_domain_port_geo", "network_intelligence_final": "network_intelligence_final",
        "destination_asn_service_agg": "destination_asn_service"}


def test_daily_job_outputs(spark, inputs):
    out = tempfile.mkdtemp(prefix="flowlens-job-")
    from flowlens.session import scratch_mark
    before = scratch_mark()
    paths = run_daily_job(spark, inputs, out, day=FIXTURE_DAY)
    assert len(paths) == 10
    assert scratch_mark() == before          # the job's scratch tables are gone
    for table, query in SAME.items():
        written = read_curated(spark, paths[table])
        expected = E.queries()[query](spark, SMALL)
        cols = expected.columns
        a = sorted(map(tuple, written.select(*cols).collect()), key=str)
        b = sorted(map(tuple, expected.collect()), key=str)
        assert a == b, table
