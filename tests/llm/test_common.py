"""What the operators share."""

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from doselens.llm import common


def session(setting, master):
    named = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=named.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting), sparkContext=context), named


def test_a_cluster_must_name_its_shared_folder():
    for master in ("local", "local[8]", "local[*]"):
        spark, named = session(None, master)
        assert common.shared_folder(spark) == common.LOCAL_CHECKPOINTS == named[0]
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://host"):
        with pytest.raises(ValueError):
            common.shared_folder(session(None, master)[0])
        assert common.shared_folder(session("s3a://shared", master)[0]) == "s3a://shared"


def test_added_columns_replace_those_of_their_name(spark):
    frame = spark.createDataFrame([(i, str(i)) for i in range(1000)], "n bigint, Text string").repartition(2)
    longer = common.add_columns(frame, "N string", lambda: lambda batch: [pa.array([f"{v}!" for v in batch.column(1).to_pylist()])])
    assert longer.columns == ["Text", "N"]
    assert longer.where(F.col("N") != F.concat("Text", F.lit("!"))).count() == 0 and longer.count() == 1000
