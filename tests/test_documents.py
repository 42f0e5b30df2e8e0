"""Whole documents: collated order, layers, what the source keeps and loses, rows that are not there."""

import json

from pyspark.sql import functions as F

from cindermill.functions.canonical import canonical_json
from cindermill.operators import constraints, documents
from cindermill.plans import rendering  # noqa: F401  it registers its queries
from cindermill.plans.registry import QUERIES

PAGE = "https://data.example.org/p"
SOURCE = {
    "processDataSet": {
        "LCIAResults": {"old": 1}, "other": {"kept": [1, {"é": "é"}]}, "administrativeInformation": {"dataEntryBy": {"common:referenceToPersonOrEntityEnteringTheData": {"@refObjectId": "r"}}, "publicationAndOwnership": {"kept": 1}},
        "exchanges": {"exchange": {"@dataSetInternalID": 3, "location": "FR", "referenceToFlowDataSet": {"@refObjectId": "F0", "@version": "01.00.000"}}},
        "modellingAndValidation": {"LCIMethodAndAllocation": {"kept": 1}, "complianceDeclarations": {}}, "processInformation": {"dataSetInformation": {"name": {"baseName": {"@xml:lang": "en", "#text": "N"}, "kept": 1}}, "quantitativeReference": {"referenceToReferenceFlow": "3"}},
    }
}
AXES = "process_index int, root_id string, root_version string, flow_id string, raw_direction string, normalization_scale double, normalized_mean_amount double, document string, version string, result_version string"
LCI = "process_index int, flow_id string, flow_version string, direction string, unit string, location string, amount double"
LCIA = "process_index int, method_id string, method_version string, amount double"
EDGES = "dependent_index int, balancing_index int, exchange_id string, flow_id string, flow_version string, location string, activity double"


def axes(spark, n=2):
    return spark.createDataFrame([(i, f"P{i}", "01.00.000", "F0", "Output", 0.5, 1e21, json.dumps(SOURCE), "03.00.000", "04.00.000") for i in range(n)], AXES)


def test_exchanges_follow_a_readers_order(spark):
    names = ["a-10", "B-1", "A-1", "ä-1", "b-2", "Z-1", "z-2", "a-2", "é-1", "e-2"]
    rows = [(0, n, "01.00.000", "input", "kg", None, 0.1) for n in names] + [(0, "f0", "02.00.000", "OUTPUT", "kg", "", 5.0), (0, "F0", "01.00.000", "Input", "kg", "DE", 1e-7)]
    row = documents.result_documents(axes(spark, 1), spark.createDataFrame(rows, LCI), spark.createDataFrame([], LCIA), "c", PAGE).first()
    data = json.loads(row.document)["processDataSet"]
    found = data["exchanges"]["exchange"]
    flows = [x["referenceToFlowDataSet"]["@refObjectId"] for x in found[1:]]
    assert flows == ["a-1", "ä-1", "a-10", "a-2", "b-1", "b-2", "é-1", "e-2", "f0", "z-1", "z-2"]  # as ECMAScript's localeCompare orders the joined keys
    assert flows != sorted(n.lower() for n in names + ["F0"]) and [x["@dataSetInternalID"] for x in found] == [str(i) for i in range(12)]
    assert found[0] == {"@dataSetInternalID": "0", "location": "FR", "referenceToFlowDataSet": {"@refObjectId": "F0", "@version": "01.00.000"}, "exchangeDirection": "Output", "meanAmount": "1e+21", "resultingAmount": "1e+21", "dataDerivationTypeStatus": "Calculated"}
    assert found[9]["location"] == "DE" and found[9]["meanAmount"] == "1e-7" and "location" not in found[1]
    assert row.n_lci == 12 and row.n_lcia == 0 and "LCIAResults" not in data
    assert data["other"] == {"kept": [1, {"é": "é"}]} and data["administrativeInformation"]["publicationAndOwnership"]["kept"] == 1
    assert data["processInformation"]["dataSetInformation"]["name"] == {"baseName": {"@xml:lang": "en", "#text": "N — aggregated LCI/LCIA result"}, "kept": 1}
    assert row.document.endswith("}\n") and row.document == json.dumps(json.loads(row.document), ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n"
    checked = spark.createDataFrame([(str(row.process_index), row.document)], "subject string, document string")
    assert constraints.document_violations(checked).count() == 0


def test_layers_and_processes_without_rows(spark):
    lci, lcia = spark.createDataFrame([], LCI), spark.createDataFrame([(1, "b", "1", 2.0), (1, "A", "1", 0.5)], LCIA)
    both = {r.process_index: r for r in documents.result_documents(axes(spark), lci, lcia, "c", PAGE).collect()}
    assert (both[0].n_lcia, both[1].n_lcia) == (0, 2)
    results = json.loads(both[1].document)["processDataSet"]["LCIAResults"]["LCIAResult"]
    assert [(x["referenceToLCIAMethodDataSet"]["@uri"], x["meanAmount"]) for x in results] == [("../lciamethods/a_1.json", "0.5"), ("../lciamethods/b_1.json", "2")]
    alone = documents.result_documents(axes(spark), lci, lcia, "c", PAGE, "lci").collect()
    assert all("LCIAResults" not in r.document and "aggregated LCI result" in r.document and r.n_lcia == 0 for r in alone)


def test_models_name_their_providers(spark):
    edges = [(0, 1, i, "F1", "01.00.000", loc, a) for i, loc, a in (("b", None, 2.0), ("A", "DE", 0.25), ("a", "", 1.0))]
    rows = {r.process_index: r for r in documents.model_documents(axes(spark), spark.createDataFrame(edges, EDGES), PAGE, "s").collect()}
    assert (rows[0].providers, rows[1].providers) == (3, 0)
    d = json.loads(rows[0].document)["lifeCycleModelDataSet"]
    found = d["lifeCycleModelInformation"]["technology"]["processes"]["processInstance"]
    assert [(x["@dataSetInternalID"], x["@multiplicationFactor"]) for x in found] == [("0", "0.5"), ("1", "1"), ("2", "0.25"), ("3", "2")]
    assert found[2]["connections"]["outputExchange"]["downstreamProcess"] == {"@id": "0", "@flowUUID": "F1", "@version": "01.00.000", "@location": "DE"}
    results = {r.process_index: r.uuid for r in documents.result_documents(axes(spark), spark.createDataFrame([], LCI), spark.createDataFrame([], LCIA), "c", PAGE).collect()}
    assert {x["referenceToProcess"]["@refObjectId"] for x in found[1:]} == {results[1]}
    information = d["lifeCycleModelInformation"]["dataSetInformation"]
    assert information["referenceToResultingProcess"]["@refObjectId"] == results[0] and "classificationInformation" not in information
    assert d["administrativeInformation"]["publicationAndOwnership"] == {"kept": 1, "common:dataSetVersion": "03.00.000", "common:permanentDataSetURI": f"{PAGE}?uuid={rows[0].uuid}&version=03.00.000", "common:workflowAndPublicationStatus": "Working draft"}


def test_lists_stay_in_spark_and_odd_items_are_canonical(spark):
    rows = [(0, 'q"\\', "1", "input", "kg", "é\x01", 1e-9), (0, "p", "1", "output", "kg", "\x1f", 123456789012345680.0), (0, "o", "1", "output", "kg", None, float("nan")), (0, "n", None, "output", "kg", "DE", -0.0), (0, "m", "1", "output", "kg", "DE", 0.1 + 0.2), (0, "l", "1", "output", "kg", "DE", -1234.5)]
    source = axes(spark, 1).withColumn("document", F.replace("document", F.lit('"kept": [1'), F.lit('"kept": ["\\u00000"')))
    frame = documents.result_documents(source, spark.createDataFrame(rows, LCI), spark.createDataFrame([(0, "ü", "1", 2.5), (0, "v", "1", 1e21)], LCIA), "c", PAGE)
    text = frame.first().document
    data = json.loads(text)
    assert text == canonical_json(data, nfc=True) + "\n" and data["processDataSet"]["other"]["kept"][0] == "\x000"
    found = data["processDataSet"]["exchanges"]["exchange"][1:]
    assert [(x["referenceToFlowDataSet"]["@refObjectId"], x.get("location"), x.get("meanAmount")) for x in found] == [("l", "DE", "-1234.5"), ("m", "DE", "0.30000000000000004"), ("n", "DE", "0"), ("o", None, None), ("p", "\x1f", "123456789012345680"), ('q"\\', "é\x01", "1e-9")]
    assert [x["meanAmount"] for x in data["processDataSet"]["LCIAResults"]["LCIAResult"]] == ["2.5", "1e+21"] and "@uri" not in found[2]["referenceToFlowDataSet"]
    python = [line for line in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "EvalPython" in line]
    assert python and not any("exchanges#" in line or "impacts#" in line for line in python)


def test_meanings_are_those_of_the_documents(spark):
    names = ["a-10", "B-1", "b-1", "ä-1", 'q"\\', "K-1", "e\u0301", "a\x00b"]
    rows = [(i, n, v, d, "kg", loc, a) for i in (0, 1) for n in names for v, d, loc, a in (("1", "input", None, 0.1), ("1", "OUTPUT", "", 1e-9), ("02.00.000", "output", "é\x01", 123456789012345680.0), (None, "Input", "DE", float("nan")))]
    rows += [(0, "b-1", "1", "input", "kg", None, a) for a in (3.0, 20.0, -0.0)] + [(0, "F0", "1", "OUTPUT", "kg", "DE", 5.0), (2, "f0", "1", "output", "kg", None, 5.0)]
    lci = spark.createDataFrame(rows, LCI)
    lcia = spark.createDataFrame([(0, n, v, a) for n in ("B", "a", "é") for v, a in (("1", 2.5), (None, 1e21))] + [(2, "m", "1", 1.0)], LCIA)
    other = F.replace(F.replace("document", F.lit('"location": "FR"'), F.lit('"location": {"b": 1.50, "a": null}')), F.lit('"@version": "01.00.000"'), F.lit('"@version": 7'))
    pivot = F.to_json(F.struct(F.col("raw_direction").alias("rawDirection"), F.col("normalized_mean_amount").alias("normalizedMeanAmount")))
    frame = axes(spark, 4).withColumn("document", F.when(F.col("process_index") == 1, other).when(F.col("process_index") == 2, F.replace("document", F.lit('"FR"'), F.lit("null"))).otherwise(F.col("document"))).withColumn("pivot", pivot)
    for layer in ("lci", "lci-lcia"):
        texts = documents.result_documents(frame, lci, lcia, "c", PAGE, layer).join(frame.select("process_index", "root_id", "root_version", "pivot"), "process_index")
        want = {r.process_index: (r.uuid, r.semantic_hash) for r in documents.with_hashes(texts, "s", layer).collect()}
        got = documents.semantic_hashes(frame, lci, lcia, "s", layer)
        assert {r.process_index: (r.uuid, r.semantic_hash) for r in got.collect()} == want and len({h for _, h in want.values()}) == 4
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "parse_json" not in plan and "lambdafunction" not in plan  # no list is written and read again, or written item by item in a lambda


def test_the_query_of_meanings_writes_no_documents(spark):
    plan = QUERIES["semantic_hash"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "lambdafunction" not in plan
