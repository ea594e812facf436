"""Source guards for the library: no local checkpoints, RDDs, Python UDFs or
cross joins; machine-local temp folders only in the local-mode fallback."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parents[1] / "martwright"
FORBIDDEN = {
    "localCheckpoint": r"localCheckpoint",
    "rdd": r"\.rdd\b",
    "python udf": r"\budf\(|pandas_udf|applyInPandas|mapInPandas",
    "cross join": r"crossJoin|how=[\"']cross",
}


def test_library_source_guards():
    hits = []
    for path in LIB.rglob("*.py"):
        if "llm" in path.parts:  # chooses its own style; its tests guard it
            continue
        text = path.read_text()
        for name, pattern in FORBIDDEN.items():
            if re.search(pattern, text):
                hits.append(f"{path.name}: {name}")
        if "tempfile" in text and path.name != "session.py":
            hits.append(f"{path.name}: tempfile")
    assert not hits, hits
