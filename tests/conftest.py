import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from premia.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        extra={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "1000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df, *order):
    """Rows as tuples, ordered by the given columns or by all."""
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


class Scans:
    """File scans of the SQL executions since it was made, from Spark's own metrics."""

    def __init__(self, spark):
        self.spark = spark
        self.since = self._last()

    def _store(self):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        return self.spark._jsparkSession.sharedState().statusStore()

    def _ids(self):
        listed = self._store().executionsList()
        return [listed.apply(i).executionId() for i in range(listed.size())]

    def _last(self):
        return max(self._ids(), default=-1)

    def found(self, path: str) -> list[tuple[str, int]]:
        """Scans of files below a path: kind of scan, and rows that came out of it."""
        out, store = [], self._store()
        for execution in [i for i in self._ids() if i > self.since]:
            nodes, values = store.planGraph(execution).allNodes(), store.executionMetrics(execution)
            for i in range(nodes.size()):
                node = nodes.apply(i)
                if not node.name().startswith("Scan ") or path not in node.desc():
                    continue
                metrics = node.metrics()
                for k in range(metrics.size()):
                    metric = metrics.apply(k)
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        out.append((node.name(), int(values.apply(metric.accumulatorId()).replace(",", ""))))
        return out


@pytest.fixture
def scans(spark):
    return lambda: Scans(spark)
