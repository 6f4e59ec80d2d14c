"""The trigram index against a plain search, and what its plans read."""
import random

import pytest

from sectorpulse.operators import search_index as SI
from sectorpulse.operators.leads import leads_search


@pytest.fixture(scope="module")
def display(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["Padaria", "ÓTICA", "Bar do Zé", "ab", "", "Posto 24h", "x\ny", "Não enriquecido", None])
    rows = [(i, *(" ".join(filter(None, (word(), word()))) if rng.random() > .1 else None for _ in range(5))) for i in range(600)]
    rows += [(600, "needle in hay", "a", "b", "c", "d")]
    return spark.createDataFrame(rows, "cnpj int, empresa string, setor string, municipio string, aberta_em string, contato string")


@pytest.fixture(scope="module")
def index(spark, display):
    return SI.build_index(spark, display, parts=16)


@pytest.mark.parametrize("text", ["needle", "padaria ót", "ZÉ", "é", "", "24h p", "x\ny", "não enriquecido", "zzz", "ria", "a%b"])
def test_search_equals_the_plain_search(spark, display, index, text):
    key = lambda r: tuple(map(str, r))
    got = SI.search(spark, index, text, parts=16)
    assert sorted(map(tuple, got.select(*display.columns).collect()), key=key) == sorted(
        map(tuple, leads_search(display, text).collect()), key=key)


def test_search_reads_only_the_matching_parts(spark, index):
    plan = SI.search(spark, index, "needle", parts=16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(__parte") == SI.RAREST
    scans = [line for line in plan.splitlines() if "FileScan" in line and "lead-index" in line]
    leads = [line for line in scans if "__bloco" in line.split("PartitionFilters: [")[1].split("]")[0]]
    assert len(leads) == 1 and len(scans) == 1 + SI.RAREST
    assert "PushedFilters: [IsNotNull(__gram), EqualTo(__gram," in plan
