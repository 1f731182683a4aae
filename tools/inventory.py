"""Print the registered analytics queries as a markdown table (name, survey ID, description, oracle)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caudal.plans import catalog  # noqa: E402


def main():
    qs, sqls = catalog.QUERIES, catalog.ORACLE
    print("| query | survey ID | what it checks | oracle |")
    print("|---|---|---|---|")
    for name in sorted(qs, key=lambda n: (re.sub(r"\d.*", "", n), int(re.search(r"\d+", n).group()), n)):
        sid = re.match(r"([a-z]+)(\d+)([a-z]?)", name)
        ident = (sid.group(1).upper() + sid.group(2).zfill(2 if sid.group(1) in ("q", "d", "a") else 1)
                 + sid.group(3)) if sid else name
        doc = " ".join((qs[name].__doc__ or "").split())
        print(f"| `{name}` | {ident} | {doc} | {'DuckDB' if name in sqls else 'rows only'} |")


if __name__ == "__main__":
    main()
