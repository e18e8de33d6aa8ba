"""Write PLANS.md: the physical plan of every registered query.

    python tools/explain_all.py [sf_dir]

Snapshot writes happen while the queries are built; the plans shown are of
the frames the queries return (what runs after the handover).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from baton.plans import plan_text, queries  # noqa: E402
from tests.conftest import make_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session()
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/explain_all.py` at `{sf_dir}` with AQE on "
           "(plans are shown before adaptive re-planning). Snapshot folder names are shortened and "
           "expression ids dropped; in text-snapshot plans the fields `0`, `1`, ... are the "
           "positional JSON keys.", ""]
    for name, fn in queries().items():
        text = plan_text(fn(spark, sf_dir), "simple").strip()
        text = re.sub(r"snapshot-[0-9a-f]{32}", "snapshot-<uuid>", text)
        text = re.sub(r"#\d+L?", "", text)
        out += [f"## `{name}`", "", "```", text, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
