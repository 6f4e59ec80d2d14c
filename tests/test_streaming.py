"""The incremental landing takes each new file exactly once."""

import os

from sectorpulse import schemas
from sectorpulse.session import local_dir
from sectorpulse.streaming import land_region


def _file(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="latin-1") as f:
        for code, cnpj in rows:
            row = dict.fromkeys(schemas.ESTABLISHMENT_LAYOUT, "")
            row.update(cnpj_basico=cnpj, codigo_municipio=code)
            f.write(";".join(f'"{row[c]}"' for c in schemas.ESTABLISHMENT_LAYOUT) + "\n")


def test_land_region_is_incremental(spark, tmp_dir):
    base = local_dir(tmp_dir)
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    mun = spark.createDataFrame([("8801", "Canoas"), ("9999", "Pelotas")], "codigo_municipio string, nome string")
    target, ckpt = f"{tmp_dir}/regional", f"{tmp_dir}/ckpt"
    _file(landing, "a.csv", [("8801", "1"), ("9999", "2")])
    land_region(spark, landing, mun, target, ckpt)
    assert spark.read.parquet(target).count() == 1
    _file(landing, "b.csv", [("8801", "3"), ("8801", "4")])
    land_region(spark, landing, mun, target, ckpt)
    land_region(spark, landing, mun, target, ckpt)  # nothing new
    got = sorted(r.cnpj_basico for r in spark.read.parquet(target).collect())
    assert got == ["1", "3", "4"]
