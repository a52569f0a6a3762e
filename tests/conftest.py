import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "8", "tests", **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4"}
    )
    yield session


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect


@pytest.fixture
def plan_nodes():
    """All nodes of a frame's last plan by class name, in stages and subqueries too."""

    def walk(df):
        found, todo = {}, [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            name = node.getClass().getSimpleName()
            found.setdefault(name, []).append(node)
            if name == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
            elif name.endswith("QueryStageExec"):
                todo.append(node.plan())
            for more in (node.children(), node.subqueries()):
                todo += [more.apply(i) for i in range(more.size())]
        return found

    return walk
