"""A saved forest applied to a Structured Streaming source gives the batch scores."""
import tempfile

import numpy as np
import pandas as pd

from txlens.operators import iforest as IF
from txlens.streaming.scoring import score_stream, training_offset


def test_stream_scores_equal_batch_scores(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=["a", "b", "c"])
    pdf.insert(0, "id", np.arange(300))
    df = spark.createDataFrame(pdf)
    model = IF.fit_isolation_forest(df, ["a", "b", "c"], "id", n_trees=20, contamination=0.05)
    base = tempfile.mkdtemp(prefix="txlens-stream-")
    model.save(spark, f"{base}/model")
    loaded = IF.IsolationForestModel.load(spark, f"{base}/model")
    batch = IF.score_samples(loaded, df, ["id"])
    offset = training_offset(batch, 0.05)
    df.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    q = (score_stream(spark, stream, loaded, offset, ["id"]).writeStream.format("memory")
         .queryName("scored_stream").option("checkpointLocation", f"{base}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM scored_stream").toPandas().sort_values("id").reset_index(drop=True)
    exp = batch.toPandas().sort_values("id").reset_index(drop=True)
    assert np.allclose(got["raw_score"], exp["raw_score"])
    assert abs(got["is_anomaly"].mean() - 0.05) <= 0.02
