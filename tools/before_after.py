"""Time the rewrites beside the plain plans they replace. usage: before_after.py [folder]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from hirelattice.operators import rule_data as rd  # noqa: E402
from hirelattice.operators.rules import rule_match, rule_match_by_join  # noqa: E402
from hirelattice.plans.bindings import REMOTE_MODES  # noqa: E402
from hirelattice.queries import Tables, joins  # noqa: E402
from hirelattice.session import build_session  # noqa: E402


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("before-after", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    dim = spark.createDataFrame(REMOTE_MODES, "id_teletravail long, type_teletravail string")
    cases = {
        "wide table: join, then group": lambda: joins._wide(t, naive=True),
        "wide table: group bridges, then join": lambda: joins._wide(t),
        "remote rules: OR join and window": lambda: rule_match_by_join(t.bind("offers"), dim, "type_teletravail", rd.REMOTE_RULES, "id_teletravail"),
        "remote rules: one projection": lambda: rule_match(t.bind("offers"), REMOTE_MODES, rd.REMOTE_RULES, "id_teletravail"),
    }
    for name, make in cases.items():
        for _ in range(2):
            begun = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
        print(f"{name:40s} {time.perf_counter() - begun:8.2f} s", flush=True)


if __name__ == "__main__":
    main()
