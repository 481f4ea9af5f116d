"""A whole run of reconciliation: its grouped fields and its audit against the plain loop over the same evidence."""

import json

from folioforge.operators import grouped as G
from folioforge.plans import extraction as X
from folioforge.plans import queries as plan
from folioforge.plans import reconciled as Z
from test_grouped import recover_field

CANDIDATES = {"experience": "experience_candidates", "projects": "project_candidates", "education": "education_candidates", "trainings_courses": "training_candidates"}
PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"


def test_grouped_fields_of_a_whole_run(spark, tmp_path):
    rows = [(i, ["small gear", "red bolt", "odd ring"][i % 3], "Brand#1", ["STEEL CO", "BRASS LAB"][i % 2], i * 7 % 50 + 1) for i in range(60)]
    spark.createDataFrame(rows, PART).write.parquet(f"{tmp_path}/part.parquet")
    evidence = {r["doc_id"]: r for r in Z.inputs(spark, str(tmp_path)).collect()}
    sides = {r["doc_id"]: (json.loads(r["parser"]), json.loads(r["optimizer"])) for r in Z.payloads(spark, str(tmp_path)).collect()}
    got = plan.QUERIES["reconciled_records"](spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(evidence) == [0, 1, 2]
    appended = 0
    for r in got:
        parser, optimizer = sides[r["doc_id"]]
        data, told = json.loads(r["data"]), {"recovered_items": [], "recovered_fields": []}
        for field in ("experience", "projects", "education", "trainings_courses"):
            texts = [e["text"] for e in evidence[r["doc_id"]][CANDIDATES[field]]]
            titles = {t for side in (parser, optimizer) for x in side["certifications"] if (t := G._flat(x).lower())}
            entries, _, audit = recover_field(field, texts, parser.get(field) or [], optimizer.get(field) or [], titles if field == "trainings_courses" else frozenset())
            assert data[field] == entries, (r["doc_id"], field)
            for k in told:
                told[k] += audit[k]
        items = [x for x in r["recovered_items"] if ":appended_from_" in x]
        assert items == told["recovered_items"] and [x for x in r["recovered_fields"] if "." in x] == told["recovered_fields"]
        # lists come before grouped fields in the audit, supplements after them
        heads = [x.split(":")[0] for x in r["recovered_items"]]
        at = [next(i for i, names in enumerate((Z._LISTS, tuple(CANDIDATES), Z._MORE)) if h in names) for h in heads]
        assert at == sorted(at) and r["mode"] == "coverage" and r["error"] is None
        appended += len(items)
    assert appended > 0


def test_a_broken_payload_fails_its_record_alone(spark, tmp_path):
    spark.createDataFrame([(i, "small gear", "Brand#1", "STEEL CO", i % 50 + 1) for i in range(40)], PART).write.parquet(f"{tmp_path}/part.parquet")
    payloads = spark.createDataFrame([(0, "[1]", "{}"), (1, "{}", '{"languages": ["English"]}')], "doc_id long, parser string, optimizer string")
    got = {r["doc_id"]: r for r in X.reconcile(Z.inputs(spark, str(tmp_path)), payloads).collect()}
    assert got[0]["data"] is None and "parser" in got[0]["error"]
    assert got[1]["error"] is None and json.loads(got[1]["data"])["languages"][0] == "English"
