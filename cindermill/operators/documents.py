"""Whole documents: result processes and lifecycle models, from source documents, inventories, impacts and edges.

Spark joins, orders and builds every part as JSON. Lists (exchanges, impacts, instances) are written by Spark in canonical
form; an Arrow function sets the small parts into the source document, and gives its canonical text in pieces between
which the lists are put, so that no list passes through Python but the items of one that hold other than plain characters.
One document holds one process's rows, as one file does. Orders that the reference sorts by language rules are collated
(root locale), not binary.

The frames: ``axes`` (process_index, root_id, root_version, flow_id, raw_direction, normalization_scale,
normalized_mean_amount, document: the source's JSON text, version, result_version), ``lci`` (process_index, flow_id,
flow_version, direction, unit, location, amount), ``lcia`` (process_index, method_id, method_version, amount), ``edges``
(dependent_index, balancing_index, exchange_id, flow_id, flow_version, location, activity). Rows that break a rule are for ``constraints``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindermill.functions import variants
from cindermill.functions.canonical import NOT_SIGNIFICANT, canonical_json, es6_number, json_hash, model_uuid, number_text, result_uuid
from cindermill.operators.inventory import by_process

#: The layers of a result, by what their documents are called.
LABELS = {"lci": "aggregated LCI result", "lci-lcia": "aggregated LCI/LCIA result"}
MODEL_LABEL = "generated resolved one-hop lifecycle model"
MODEL_COMMENT = "Deterministically generated resolved one-hop model from a frozen Unit Process, direct provider edges, and Result Catalog."
STATUS = "Working draft"
MODEL_ATTRIBUTES = {
    "@xmlns": "http://eplca.jrc.ec.europa.eu/ILCD/LifeCycleModel/2017", "@xmlns:acme": "http://acme.com/custom", "@xmlns:common": "http://lca.jrc.it/ILCD/Common",
    "@xmlns:xsi": "http://www.w3.org/2001/XMLSchema-instance", "@locations": "../ILCDLocations.xml", "@version": "1.1",
    "@xsi:schemaLocation": "http://eplca.jrc.ec.europa.eu/ILCD/LifeCycleModel/2017 ../../schemas/ILCD_LifeCycleModelDataSet.xsd",
}


def collated(*parts: Column | str) -> Column:
    """The joined key by which rows are ordered as a reader would."""
    return F.collate(F.concat_ws("|", *parts), "UNICODE")


def reference(type_: str, category: str, uuid: Column, version: Column, description: str) -> dict:
    """The fields of a global reference; ``uuid`` in lower case."""
    return {"@refObjectId": uuid, "@type": type_, "@uri": [f"../{category}/", uuid, "_", version, ".json"], "@version": version, "common:shortDescription": {"#text": description, "@xml:lang": "en"}}


def struct_of(fields: dict) -> Column:
    """Fields as a struct: a text is fixed, a list is joined, a dict is nested, a tuple of one column is a field that may be missing."""
    value = lambda v: F.lit(v) if isinstance(v, str) else F.concat(*map(value, v)) if isinstance(v, list) else struct_of(v) if isinstance(v, dict) else v[0] if isinstance(v, tuple) else v
    return F.struct(*[value(v).alias(k) for k, v in fields.items()])


def plain_json(fields: dict) -> Column:
    """Fields as canonical text, where all columns are plain texts (see ``odd``). A field that may be missing can't be the last of its object."""
    out: list = []

    def put(x) -> None:
        if isinstance(x, str) and out and isinstance(out[-1], str):
            out[-1] += x
        else:
            out.append(x)

    def write(fields: dict) -> None:
        last = max(fields)
        put("{")
        for k in sorted(fields):
            v, name = fields[k], f"{json.dumps(k)}:"
            comma = "" if k == last else ","
            if isinstance(v, tuple):
                assert comma
                put(F.when(v[0].isNotNull(), F.concat_ws("", F.lit(f'{name}"'), v[0], F.lit('",'))).otherwise(""))
                continue
            put(name)
            if isinstance(v, dict):
                write(v)
            else:
                put('"')
                for x in v if isinstance(v, list) else [v]:
                    put(json.dumps(x, ensure_ascii=False)[1:-1] if isinstance(x, str) else x)
                put('"')
            put(comma)
        put("}")

    write(fields)
    return F.concat_ws("", *[F.lit(x) if isinstance(x, str) else x for x in out])  # inside lambdas concat is far slower


def global_reference(type_: str, category: str, uuid: Column, version: Column, description: str) -> Column:
    return struct_of(reference(type_, category, F.lower(uuid), version, description))


#: Fields of items that hold numbers as texts. A number that Spark can't write as ECMAScript does is marked, for ``_settled``.
AMOUNTS, MARK = ("meanAmount", "resultingAmount", "@multiplicationFactor"), "\x00"


def amount_text(amount: Column) -> Column:
    """An amount as ECMAScript prints it, or marked. Decimals of 15 digits at most that give the same double are its shortest text."""
    amount = amount.cast("double")
    short = amount.try_cast("decimal(15,3)")
    text = F.rtrim(F.rtrim(short.cast("string"), F.lit("0")), F.lit("."))
    return F.when(~F.isnan(amount), F.when(short.cast("double") == amount, text).otherwise(F.concat(F.lit(MARK), amount.cast("string"))))


def odd(*texts: Column) -> Column:
    """Whether any of these is missing or has other characters than those that stand for themselves in JSON text and have one Unicode form."""
    return ~F.coalesce(F.concat(*texts).rlike(r"\A[ !#-\[\]-~]*\z"), F.lit(False))


def _settled(text: str, of: Callable[[dict], dict]) -> str:
    item = json.loads(text)
    for k in AMOUNTS:
        if str(item.get(k, "")).startswith(MARK):
            item[k] = es6_number(float(item[k][1:]))
    return canonical_json(of(item), nfc=True)


def settled(is_odd: Column, fields: dict, of: Callable[[dict], dict] = dict) -> Column:
    """The canonical text of the items (or of what ``of`` makes of them) that are odd, for ``listed`` and ``meant``; null for all others."""
    return F.pandas_udf(lambda s: s.map(lambda x: None if x is None else _settled(x, of)), "string")(F.when(is_odd, F.to_json(struct_of(fields))))


def listed(items: Column, fields: Callable, number: bool = True) -> Column:
    """The items of a list (``settled`` or plain ``fields``) as canonical text, with their places (from 1) as ids in front."""
    text = lambda x: F.coalesce(x["settled"], plain_json(fields(lambda c: x[c])))
    if not number:
        return F.array_join(F.transform(items, text), ",")
    return F.array_join(F.transform(items, lambda x, i: F.concat_ws("", F.lit(',{"@dataSetInternalID":"'), (i + 1).cast("string"), F.lit('",'), F.substring(text(x), 2, 1 << 30))), "")


def proper_direction(c: str) -> Column:
    return F.initcap(F.lower(c))


def exchange(c: Callable) -> dict:
    flow = reference("flow data set", "flows", c("flow_id"), c("flow_version"), "Aggregated inventory flow")
    return {"referenceToFlowDataSet": flow, "location": (c("location"),), "exchangeDirection": c("direction"), "meanAmount": c("text"), "resultingAmount": c("text"), "dataDerivationTypeStatus": "Calculated"}


#: By what exchanges and impacts are put in order; equal keys go by the fields.
EXCHANGE_ORDER = ("k", "flow_id", "flow_version", "location", "direction", "text")
IMPACT_ORDER = ("k", "method_id", "method_version", "text")


def exchange_rows(axes: DataFrame, lci: DataFrame) -> DataFrame:
    """The fields of every inventory row as exchanges have them, whether it is odd, and whether it is kept: rows of a process's own reference flow and direction are not exchanges."""
    c = F.col
    own = axes.select("process_index", F.lower("flow_id").alias("own_flow"), "raw_direction")
    key = collated("flow_id", "flow_version", "direction", "unit", F.coalesce("location", F.lit("")))
    rows = lci.join(own, "process_index").select(
        "process_index", "own_flow", "raw_direction", key.alias("k"), F.lower("flow_id").alias("flow_id"), "flow_version", F.nullif("location", F.lit("")).alias("location"), proper_direction("direction").alias("direction"), amount_text(c("amount")).alias("text")
    )
    kept = ~((c("flow_id") == c("own_flow")) & (c("direction") == c("raw_direction")))
    is_odd = odd(c("flow_id"), c("flow_version"), c("direction"), F.coalesce("location", F.lit("")), c("text"))
    return rows.select("process_index", *EXCHANGE_ORDER, kept.alias("kept"), is_odd.alias("odd"))


def inventories(axes: DataFrame, lci: DataFrame) -> DataFrame:
    """process_index, exchanges (JSON objects in order, numbered, each after a comma), n_lci: all of a process's rows count."""
    c = F.col
    rows = exchange_rows(axes, lci).withColumn("settled", settled(c("odd"), exchange(c)))
    found = F.collect_list(F.when(c("kept"), F.struct(*EXCHANGE_ORDER, "settled")))  # nulls are not collected
    per = rows.groupBy("process_index").agg(F.array_sort(found).alias("found"), F.count("*").alias("n_lci"))
    return per.select("process_index", listed(c("found"), exchange).alias("exchanges"), "n_lci")


def impact(c: Callable) -> dict:
    return {"referenceToLCIAMethodDataSet": reference("LCIA method data set", "lciamethods", c("method_id"), c("method_version"), "LCIA method result"), "meanAmount": c("text")}


def impact_rows(lcia: DataFrame) -> DataFrame:
    c = F.col
    rows = lcia.select("process_index", collated("method_id", "method_version").alias("k"), F.lower("method_id").alias("method_id"), "method_version", amount_text(c("amount")).alias("text"))
    return rows.withColumn("odd", odd(c("method_id"), c("method_version"), c("text")))


def impacts(lcia: DataFrame) -> DataFrame:
    """process_index, impacts (JSON objects in order, with commas between), n_lcia."""
    c = F.col
    rows = impact_rows(lcia).withColumn("settled", settled(c("odd"), impact(c)))
    per = rows.groupBy("process_index").agg(F.array_sort(F.collect_list(F.struct(*IMPACT_ORDER, "settled"))).alias("found"), F.count("*").alias("n_lcia"))
    return per.select("process_index", listed(c("found"), impact, number=False).alias("impacts"), "n_lcia")


def set_parts(document: dict, root: str, parts: dict, suffix: str, gone: tuple[str, ...] = ()) -> dict:
    """``document`` with each part at its path below ``root``, its English base names suffixed."""
    data = document[root]
    for key in gone:
        data.pop(key, None)
    for path, value in parts.items():
        *way, last = path.split("/")
        at = data
        for key in way:
            at = at.setdefault(key, {})
        at[last] = value
    suffix_names(data["processInformation"]["dataSetInformation"]["name"], suffix)
    return document


def suffix_names(name: dict, suffix: str) -> dict:
    many = name["baseName"] if isinstance(name["baseName"], list) else [name["baseName"]]
    for item in many:
        if isinstance(item, dict) and item.get("@xml:lang") == "en":
            item["#text"] = f"{item['#text']} — {suffix}"
    return name


def pieces(build: Callable[[str], dict], lists: int, end: str = "\n") -> list[str]:
    """The canonical text of a document in the pieces between its lists; ``build`` sets the text it is given as their item. A text that the document has elsewhere too is no mark."""
    for i in count():
        found = (canonical_json(build(f"{MARK}{i}"), nfc=True) + end).split(json.dumps(f"{MARK}{i}"))
        if len(found) == lists + 1:
            return found


def result_pieces(source: str, parts: str, suffix: str) -> list[str]:
    """Before the impacts (if there are any), before the exchanges and after them."""
    lists = 1 + ("LCIAResults" in json.loads(parts))

    def build(mark: str) -> dict:
        own = json.loads(parts)
        own["exchanges"]["exchange"].append(mark)
        if lists == 2:
            own["LCIAResults"]["LCIAResult"].append(mark)
        return set_parts(json.loads(source), "processDataSet", own, suffix, ("exchanges", "LCIAResults"))

    *first, before, after = pieces(build, lists)
    return [*first, before[:-1], after]  # less the comma, as every exchange has one


def model_pieces(source: str, parts: str, suffix: str) -> list[str]:
    """Before the instances of providers and after them: what a model takes over from the source's document, and its own parts."""

    def build(mark: str) -> dict:
        own = json.loads(parts)
        own["instances"].append(mark)
        return model_document(json.loads(source)["processDataSet"], own, suffix)

    before, after = pieces(build, 1)
    return [before[:-1], after]


def model_document(data: dict, own: dict, suffix: str) -> dict:
    info = data["processInformation"]["dataSetInformation"]
    publication = data["administrativeInformation"]["publicationAndOwnership"]
    publication.update(own["publication"])
    reviewer = data["administrativeInformation"]["dataEntryBy"]["common:referenceToPersonOrEntityEnteringTheData"]
    information = own["information"] | {"name": suffix_names(info["name"], suffix)}
    if "classificationInformation" in info:
        information["classificationInformation"] = info["classificationInformation"]
    validation = {"validation": {"review": {"@type": "Not reviewed", "common:referenceToNameOfReviewerAndInstitution": reviewer}}}
    if "complianceDeclarations" in data["modellingAndValidation"]:
        validation["complianceDeclarations"] = data["modellingAndValidation"]["complianceDeclarations"]
    body = MODEL_ATTRIBUTES | {
        "lifeCycleModelInformation": {"dataSetInformation": information, "quantitativeReference": {"referenceToReferenceProcess": 0}, "technology": {"processes": {"processInstance": own["instances"]}}},
        "modellingAndValidation": validation, "administrativeInformation": data["administrativeInformation"],
    }
    return {"lifeCycleModelDataSet": body}


def rendered(f, source: Column, parts: Column, suffix: str) -> Column:
    return F.pandas_udf(lambda s, p: s.combine(p, lambda a, b: f(a, b, suffix)), "array<string>")(source, parts)


def publication(uuid: str, page: str) -> list[Column]:
    """The fields of the publication; ``page`` is where a dataset can be seen, before its query."""
    uri = F.concat(F.lit(f"{page}?uuid="), uuid, F.lit("&version="), "version")
    return [F.col("version").alias("common:dataSetVersion"), uri.alias("common:permanentDataSetURI"), F.lit(STATUS).alias("common:workflowAndPublicationStatus")]


def array_json(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def result_documents(axes: DataFrame, lci: DataFrame, lcia: DataFrame, calculation: str, page: str, layer: str = "lci-lcia") -> DataFrame:
    """process_index, uuid, version, n_lci, n_lcia, document (canonical text) of every axis's result; ``layer`` lci leaves impacts out."""
    label = LABELS[layer]
    rows = axes.withColumn("uuid", result_uuid(F.col("root_id"), F.col("flow_id"))).withColumn("amount_text", number_text(F.col("normalized_mean_amount")))
    rows = rows.join(inventories(axes, lci), "process_index", "left")
    if layer == "lci-lcia":
        rows = rows.join(impacts(lcia), "process_index", "left")
    else:
        rows = rows.withColumns({"impacts": F.lit(None).cast("string"), "n_lcia": F.lit(0)})
    d = variants.at(variants.document(F.col("document")), "processDataSet")
    reference = variants.text(d, "processInformation", "quantitativeReference", "referenceToReferenceFlow")
    x = F.get(F.filter(variants.many(variants.at(d, "exchanges", "exchange")), lambda e: variants.text(e, "@dataSetInternalID") == F.col("reference")), F.lit(0))
    rows = rows.withColumn("reference", reference).withColumn("x", x)
    own = F.concat(
        F.lit('{"@dataSetInternalID":"0",'), F.coalesce(F.concat(F.lit('"location":'), F.to_json(variants.at(F.col("x"), "location")), F.lit(",")), F.lit("")), F.lit('"referenceToFlowDataSet":'), F.to_json(variants.at(F.col("x"), "referenceToFlowDataSet")), F.lit(","),
        F.substring(F.to_json(F.struct(F.col("raw_direction").alias("exchangeDirection"), F.col("amount_text").alias("meanAmount"), F.col("amount_text").alias("resultingAmount"), F.lit("Calculated").alias("dataDerivationTypeStatus"))), 2, 1 << 30),
    )
    comment = F.concat(F.lit(f"{label} generated for "), "root_id", F.lit("@"), "root_version", F.lit(f" under calculation {calculation}."))
    information, publish = "processInformation/dataSetInformation", "administrativeInformation/publicationAndOwnership"
    scalars = F.to_json(F.struct(
        F.col("uuid").alias(f"{information}/common:UUID"), F.struct(F.lit("en").alias("@xml:lang"), comment.alias("#text")).alias(f"{information}/common:generalComment"),
        F.lit("LCI result").alias("modellingAndValidation/LCIMethodAndAllocation/typeOfDataSet"), F.lit("0").alias("processInformation/quantitativeReference/referenceToReferenceFlow"),
        *[c.alias(f"{publish}/{name}") for c, name in zip(publication("uuid", page), ("common:dataSetVersion", "common:permanentDataSetURI", "common:workflowAndPublicationStatus"), strict=True)],
    ))
    results = F.when(F.col("n_lcia") > 0, F.lit(',"LCIAResults":{"LCIAResult":[]}')).otherwise("")
    parts = F.concat(F.left(scalars, F.length(scalars) - 1), F.lit(',"exchanges":{"exchange":['), own, F.lit("]}"), results, F.lit("}"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = rows.select("process_index", "uuid", "version", zero("n_lci"), zero("n_lcia"), "exchanges", "impacts", rendered(result_pieces, F.col("document"), parts, label).alias("p"))
    p, exchanges = F.col("p"), F.coalesce("exchanges", F.lit(""))
    document = F.when(F.col("n_lcia") > 0, F.concat(p[0], "impacts", p[1], exchanges, p[2])).otherwise(F.concat(p[0], exchanges, p[1]))
    return rows.select("process_index", "uuid", "version", "n_lci", "n_lcia", document.alias("document"))


def instance(c: Callable) -> dict:
    down = {"@id": "0", "@flowUUID": c("flow_id"), "@version": c("flow_version"), "@location": (c("location"),)}
    provider = reference("process data set", "processes", c("result_uuid"), c("result_version"), "Provider aggregated Result Process")
    return {"@multiplicationFactor": c("factor"), "referenceToProcess": provider, "connections": {"outputExchange": {"@flowUUID": c("flow_id"), "@version": c("flow_version"), "downstreamProcess": down}}}


def model_documents(axes: DataFrame, edges: DataFrame, page: str, schema: str) -> DataFrame:
    """process_index, uuid, version, providers, document (canonical text) of every axis's model: itself as instance 0 and one instance an edge, whose provider's result is named."""
    named = axes.withColumn("uuid", model_uuid(F.col("root_id"), F.col("flow_id"), schema)).withColumn("result_uuid", result_uuid(F.col("root_id"), F.col("flow_id")))
    results = named.select(F.col("process_index").alias("balancing_index"), "result_uuid", "result_version")
    c = F.col
    key = F.struct(F.collate(c("exchange_id").cast("string"), "UNICODE").alias("a"), c("balancing_index").alias("b"), F.collate(c("flow_id"), "UNICODE").alias("c"))
    linked = edges.join(results, "balancing_index").select(
        c("dependent_index").alias("process_index"), key.alias("k"), c("flow_id").cast("string").alias("flow_id"), "flow_version", F.nullif("location", F.lit("")).alias("location"), amount_text(c("activity")).alias("factor"), F.lower("result_uuid").alias("result_uuid"), "result_version"
    )
    linked = linked.withColumn("settled", settled(odd(c("flow_id"), c("flow_version"), F.coalesce("location", F.lit("")), c("factor"), c("result_uuid"), c("result_version")), instance(c)))
    found = F.collect_list(F.struct("k", "factor", "result_uuid", "result_version", "flow_id", "flow_version", "location", "settled"))
    per = linked.groupBy("process_index").agg(F.array_sort(found).alias("found"), F.count("*").alias("providers")).select("process_index", listed(c("found"), instance).alias("instances"), "providers")
    rows = named.join(per, "process_index", "left").withColumn("scale_text", number_text(F.col("normalization_scale")))
    root = F.to_json(F.struct(F.lit("0").alias("@dataSetInternalID"), F.col("scale_text").alias("@multiplicationFactor"), global_reference("process data set", "processes", F.col("root_id"), F.col("root_version"), "Root Unit Process").alias("referenceToProcess")))
    information = F.struct(
        F.col("uuid").alias("common:UUID"), global_reference("process data set", "processes", F.col("result_uuid"), F.col("result_version"), "Generated aggregated Result Process").alias("referenceToResultingProcess"),
        F.struct(F.lit("en").alias("@xml:lang"), F.lit(MODEL_COMMENT).alias("#text")).alias("common:generalComment"),
    )
    head = F.to_json(F.struct(information.alias("information"), F.struct(*publication("uuid", page)).alias("publication")))
    parts = F.concat(F.left(head, F.length(head) - 1), F.lit(',"instances":['), root, F.lit("]}"))
    rows = rows.select("process_index", "uuid", "version", F.coalesce("providers", F.lit(0)).cast("long").alias("providers"), "instances", rendered(model_pieces, F.col("document"), parts, MODEL_LABEL).alias("p"))
    document = F.concat(F.col("p")[0], F.coalesce("instances", F.lit("")), F.col("p")[1])
    return rows.select("process_index", "uuid", "version", "providers", document.alias("document"))


#: The profile of a layer's results.
PROFILES = {"lci": "lci-result.v2", "lci-lcia": "lci-lcia-result.v2"}


def semantic_projection(d: Column, schema: str, profile: str) -> Column:
    """What a result document (``d``: its data set as a variant) means, as JSON: beside the columns uuid, root_id, root_version and pivot (JSON), its references, exchanges and impacts without names, numbers of places or texts. ``schema`` names the contract."""
    identity = lambda v: F.struct(F.lower(variants.text(v, "@refObjectId")).alias("uuid"), variants.text(v, "@version").alias("version"))
    location = lambda x: F.coalesce(F.to_json(variants.at(x, "location")), F.lit("null"))
    exchange = lambda x: F.concat_ws(
        "", F.lit('{"location":'), location(x), F.lit(","), F.substring(F.to_json(F.struct(identity(variants.at(x, "referenceToFlowDataSet")).alias("flow"), variants.text(x, "exchangeDirection").alias("direction"), variants.text(x, "meanAmount").alias("meanAmount"))), 2, 1 << 30)
    )
    impact = lambda x: F.to_json(F.struct(identity(variants.at(x, "referenceToLCIAMethodDataSet")).alias("method"), variants.text(x, "meanAmount").alias("meanAmount")))
    head = F.to_json(F.struct(
        F.lit(schema).alias("schema"), F.lit(profile).alias("profile"), F.col("uuid"), F.struct(F.col("root_id").alias("id"), F.col("root_version").alias("version")).alias("sourceProcess"),
        variants.text(d, "modellingAndValidation", "LCIMethodAndAllocation", "typeOfDataSet").alias("typeOfDataSet"),
    ))
    return F.concat(
        F.left(head, F.length(head) - 1), F.lit(',"referencePivot":'), "pivot", F.lit(',"quantitativeReference":'), F.to_json(variants.at(d, "processInformation", "quantitativeReference")),
        F.lit(',"exchanges":'), array_json(F.transform(variants.many(variants.at(d, "exchanges", "exchange")), exchange)), F.lit(',"lciaResults":'), array_json(F.transform(variants.many(variants.at(d, "LCIAResults", "LCIAResult")), impact)), F.lit("}"),
    )


def with_hashes(rows: DataFrame, schema: str, layer: str = "lci-lcia") -> DataFrame:
    """Result documents (uuid, root_id, root_version, pivot, document) with the hashes of what they mean, of what counts as a change, and of all of it."""
    read = rows.withColumn("d", variants.at(variants.document(F.col("document")), "processDataSet"))
    return read.withColumns({
        "semantic_hash": json_hash(semantic_projection(F.col("d"), schema, PROFILES[layer])), "significant_hash": json_hash(F.col("document"), without=NOT_SIGNIFICANT), "content_hash": json_hash(F.col("document")),
    }).drop("d")


def _scalar(value) -> str | None:
    return None if value is None or isinstance(value, (dict, list)) else value if isinstance(value, str) else canonical_json(value)


def _meaning(item: dict, reference: str, name: str, **fields) -> dict:
    to = item.get(reference)
    to = to if isinstance(to, dict) else {}
    uuid, version = _scalar(to.get("@refObjectId")), _scalar(to.get("@version"))
    identity = {"uuid": uuid and uuid.lower(), "version": version}
    texts = {k: _scalar(item.get(v)) for k, v in fields.items()}
    return {name: {k: v for k, v in identity.items() if v is not None}} | {k: v for k, v in texts.items() if v is not None}


def exchange_meaning(item: dict) -> dict:
    """What an exchange of a document means, as in ``semantic_projection``."""
    return _meaning(item, "referenceToFlowDataSet", "flow", direction="exchangeDirection", meanAmount="meanAmount") | {"location": item.get("location")}


def impact_meaning(item: dict) -> dict:
    return _meaning(item, "referenceToLCIAMethodDataSet", "method", meanAmount="meanAmount")


def exchanges_meant(axes: DataFrame, lci: DataFrame) -> DataFrame:
    """process_index, exchanges: what the exchanges of ``inventories`` mean, in the same order, with commas between."""
    c = F.col
    rows = exchange_rows(axes, lci).where("kept").withColumn("settled", settled(c("odd"), exchange(c), exchange_meaning))
    location = F.coalesce(F.concat(F.lit('"'), "location", F.lit('"')), F.lit("null"))
    plain = F.concat(F.lit('{"direction":"'), "direction", F.lit('","flow":{"uuid":"'), "flow_id", F.lit('","version":"'), "flow_version", F.lit('"},"location":'), location, F.lit(',"meanAmount":"'), "text", F.lit('"}'))
    return rows.groupBy("process_index").agg(meant(EXCHANGE_ORDER, plain).alias("exchanges"))


def impacts_meant(lcia: DataFrame) -> DataFrame:
    """process_index, impacts: what those of ``impacts`` mean, in the same order, with commas between."""
    c = F.col
    rows = impact_rows(lcia).withColumn("settled", settled(c("odd"), impact(c), impact_meaning))
    plain = plain_json({"meanAmount": c("text"), "method": {"uuid": c("method_id"), "version": c("method_version")}})
    return rows.groupBy("process_index").agg(meant(IMPACT_ORDER, plain).alias("impacts"))


def meant(order: tuple[str, ...], plain: Column) -> Column:
    """The ``settled`` or ``plain`` meanings of a group's items, written before they are gathered, so that no lambda runs over them."""
    found = F.sort_array(F.collect_list(F.struct(*order, F.coalesce("settled", plain).alias("meaning"))))
    return F.array_join(found["meaning"], ",")


def meaning_pieces(source: str, head: str) -> list[str]:
    """Before a result's further exchanges, from these to its impacts, and after them: what its document means, as in ``semantic_projection``.

    ``head`` has what the source has not, and the result's own fields of the reference exchange.
    """
    data, means = json.loads(source)["processDataSet"], json.loads(head)
    quantity, many = data["processInformation"]["quantitativeReference"], data["exchanges"]["exchange"]
    flow = _scalar(quantity["referenceToReferenceFlow"])
    found = [x for x in (many if isinstance(many, list) else [many]) if isinstance(x, dict) and _scalar(x.get("@dataSetInternalID")) == flow]
    if flow is None or not found:
        raise ValueError("reference exchange missing")
    own = {"location": found[0].get("location"), "referenceToFlowDataSet": found[0]["referenceToFlowDataSet"]} | means.pop("own")
    means["quantitativeReference"] = quantity | {"referenceToReferenceFlow": "0"}
    first, *others = pieces(lambda mark: means | {"exchanges": [exchange_meaning(own), mark], "lciaResults": [mark]}, 2, "")
    return [first[:-1], *others]  # less the comma, as there may be no further exchange


def semantic_hashes(axes: DataFrame, lci: DataFrame, lcia: DataFrame, schema: str, layer: str = "lci-lcia") -> DataFrame:
    """process_index, uuid, version, semantic_hash of every axis's result document, as ``with_hashes`` finds it in the text; ``axes`` with pivot (JSON).

    The text of a document is not written and read again: what the items of its lists mean is written by Spark, and put
    between the pieces of what the rest means.
    """
    c = F.col
    rows = by_process(axes).withColumns({"uuid": result_uuid(c("root_id"), c("flow_id")), "amount_text": number_text(c("normalized_mean_amount"))})
    head = F.to_json(F.struct(
        F.lit(schema).alias("schema"), F.lit(PROFILES[layer]).alias("profile"), F.lit("LCI result").alias("typeOfDataSet"), c("uuid"), F.struct(c("root_id").alias("id"), c("root_version").alias("version")).alias("sourceProcess"),
        F.struct(c("raw_direction").alias("exchangeDirection"), c("amount_text").alias("meanAmount")).alias("own"),
    ))
    head = F.concat(F.left(head, F.length(head) - 1), F.lit(',"referencePivot":'), "pivot", F.lit("}"))
    cut = F.pandas_udf(lambda s, h: s.combine(h, lambda a, b: None if b is None else meaning_pieces(a, b)), "array<string>")
    rows = rows.select("process_index", "uuid", "version", cut("document", head).alias("p")).join(exchanges_meant(axes, lci), "process_index", "left")
    rows = rows.join(impacts_meant(lcia), "process_index", "left") if layer == "lci-lcia" else rows.withColumn("impacts", F.lit(None).cast("string"))
    p, none = c("p"), F.lit("")
    text = F.concat(p[0], F.coalesce(F.concat(F.lit(","), "exchanges"), none), p[1], F.coalesce("impacts", none), p[2])
    return rows.select("process_index", "uuid", "version", F.sha2(text, 256).alias("semantic_hash"))
