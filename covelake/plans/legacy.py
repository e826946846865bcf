"""Reading other legacy tools: PowerCenter mappings, DataStage jobs, Cognos reports; and the waves of a whole estate.

Each reader turns an export's text into ``Work``: what it reads and writes, its parts, parameters, notes on what means
something else elsewhere, and a weight. Nothing is run.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from covelake.plans import lineage
from covelake.plans.graph import Graph, Model

SAS, POWERCENTER, DATASTAGE, COGNOS = "SAS", "PowerCenter", "DataStage", "Cognos"
#: Schemas that are one layer under another name.
ALIASES = {"pa": "src", "policyadmin": "src"}

# Weights of the tools' parts; parts that aren't listed weigh 2, a piece of work itself 2.
PART_WEIGHTS = {
    "Source Qualifier": 1, "Expression": 2, "Filter": 1, "Lookup Procedure": 3, "Aggregator": 3, "Router": 3, "Joiner": 3, "Update Strategy": 3, "Sequence": 2, "Normalizer": 4,
    "Rank": 3, "Stored Procedure": 5, "Java": 5, "Mapplet": 4,
    "OracleConnectorPX": 1, "DB2ConnectorPX": 1, "PxSequentialFile": 1, "PxLookup": 3, "PxJoin": 3, "PxAggregator": 3, "CTransformerStage": 3, "PxFunnel": 2, "PxRemDup": 2, "PxSort": 1, "PxChangeCapture": 4,
}
#: PowerCenter functions: (what to write, what differs).
MAPPING_FUNCTIONS = {
    "DECODE": ("decode_iif or CASE", "it finds null equal to null"), "IIF": ("CASE", "nested ones read better as one CASE"), "ISNULL": ("IS NULL", ""), "NVL": ("coalesce", ""),
    "TO_CHAR": ("date_format", "masks differ"), "TO_DATE": ("to_date", "masks differ"), "LTRIM": ("ltrim", ""), "SYSDATE": ("current_timestamp", "time zone of the server"),
}
#: DataStage functions, by the text that shows them.
JOB_FUNCTIONS = {
    "DateToString": ("date_format", "masks differ"), "StringToDate": ("to_date", "masks differ"), "NullToZero": ("coalesce(x, 0)", ""), "IsNull": ("IS NULL", ""), "Trim": ("trim", "it also joins blanks inside"), "If ": ("CASE", ""),
}
#: What a failed lookup of a job does.
LOOKUP_FAILURE = {"Continue": "left join", "Drop": "inner join", "Reject": "inner join, and a table of rejects", "Fail": "inner join, and a test that stops"}
UPSERTS = {"upsert", "update then insert", "insert then update"}


@dataclass
class Note:
    code: str
    severity: str
    where: str
    text: str


@dataclass
class Work:
    tool: str
    name: str
    reads: list[str] = field(default_factory=list)
    writes: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    parameters: list[str] = field(default_factory=list)
    notes: list[Note] = field(default_factory=list)
    weight: int = 2
    readiness: str = ""

    @property
    def effort(self) -> tuple[str, float]:
        return lineage.effort(self.weight)

    def part(self, kind: str, name: str) -> None:
        self.parts.append(f"{kind}: {name}")
        self.weight += PART_WEIGHTS.get(kind, 2)

    def note(self, code: str, severity: str, where: str, text: str, weight: int = 0) -> None:
        self.notes.append(Note(code, severity, where, text))
        self.weight += weight

    def done(self) -> Work:
        self.reads, self.writes, self.parameters = (list(dict.fromkeys(x)) for x in (self.reads, self.writes, self.parameters))
        return self


def table(name: str) -> str:
    """``schema.table`` in lower case: a ``#parameter#`` is the warehouse, so is no schema; aliases are resolved."""
    *schema, last = re.sub(r"#[^#]+#", "dwh", name.strip().strip('"').lower()).rsplit(".", 1)
    return f"{ALIASES.get(schema[0], schema[0]) if schema else 'dwh'}.{last}"


def tables_in(sql: str) -> list[str]:
    """Tables after FROM and JOIN, commas between them included; names of common table expressions go."""
    bare = re.sub(r"'[^']*'|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)
    own = {m.lower() for m in re.findall(r"(?:\bwith\b|,)\s*(\w+)\s+as\s*\(", bare, re.I)}
    one = r'[#\w".$]+(?:\s+(?:as\s+)?(?!(?:where|join|left|right|inner|full|cross|on|group|order|union|having|using|natural)\b)\w+)?'
    found = [part.split()[0] for clause in re.findall(rf"\b(?:from|join)\s+({one}(?:\s*,\s*{one})*)", bare, re.I) for part in clause.split(",")]
    return list(dict.fromkeys(table(t) for t in found if t.lower() not in own))


def _function_notes(work: Work, prefix: str, where: str, expression: str, functions: dict[str, tuple[str, str]], called: bool) -> None:
    for name, (instead, differs) in functions.items():
        if re.search(rf"\b{name}\s*\(", expression, re.I) if called else name in expression:
            work.note(f"{prefix}-FN-{name.strip()}", "medium" if differs else "low", where, f"{expression}: {instead}" + (f"; {differs}" if differs else ""), 1)


def mappings(text: str) -> Iterator[Work]:
    """Mappings of a PowerCenter repository export."""
    for folder in ET.fromstring(text.encode("utf-8")).iter("FOLDER"):
        owner = {(kind, x.get("NAME")): x.get("OWNERNAME") or "" for kind in ("SOURCE", "TARGET") for x in folder.iter(kind)}
        for m in folder.iter("MAPPING"):
            work = Work(POWERCENTER, m.get("NAME"))
            sides = {"SOURCE": work.reads, "TARGET": work.writes}
            for i in m.iter("INSTANCE"):
                if i.get("TYPE") in sides:
                    name, schema = i.get("TRANSFORMATION_NAME"), owner.get((i.get("TYPE"), i.get("TRANSFORMATION_NAME")))
                    sides[i.get("TYPE")].append(table(f"{schema}.{name}" if schema else name))
            for t in m.iter("TRANSFORMATION"):
                _transformation(work, t, t.get("TYPE"), t.get("NAME"), {a.get("NAME"): a.get("VALUE") or "" for a in t.iter("TABLEATTRIBUTE")})
            for session in folder.iter("SESSION"):
                if session.get("MAPPINGNAME") == work.name and any((a.get("NAME"), a.get("VALUE")) == ("Update else Insert", "YES") for a in session.iter("ATTRIBUTE")):
                    work.note("INFA-SES-01", "medium", session.get("NAME"), "the session updates or inserts, which the mapping doesn't show: a merge by the target's key")
            flows = [w.get("NAME") for w in folder.iter("WORKFLOW") if any(x.get("TASKNAME") == f"s_{work.name}" for x in w.iter("TASKINSTANCE"))]
            work.parts += [f"Workflow: {f}" for f in flows]
            yield work.done()


def _transformation(work: Work, node, kind: str, name: str, has: dict[str, str]) -> None:
    work.part(kind, name)
    if kind == "Source Qualifier":
        if has.get("Sql Query"):
            work.note("INFA-SQ-01", "high", name, "the real logic is in a query that replaces the source", 3)
            work.reads += tables_in(has["Sql Query"])
        if has.get("Source Filter"):
            work.note("INFA-SQ-02", "low", name, f"source filter: {has['Source Filter']}")
    elif kind == "Lookup Procedure":
        if has.get("Lookup table name"):
            work.reads.append(table(has["Lookup table name"]))
        if (many := has.get("Lookup policy on multiple match", "")).startswith(("Use Any", "Use First", "Use Last")):
            work.note("INFA-LKP-01", "high", name, f"{many}: which row comes back is open unless the key is unique; take the first by a total order")
        work.note("INFA-LKP-02", "medium", name, "without a match the columns are null: a left join, and a test of completeness")
    elif kind == "Router":
        work.note("INFA-RTR-01", "high", name, f"{len(node.findall('GROUP'))} groups: rows of another group never reach the default group, which is NOT any condition")
    elif kind == "Update Strategy":
        work.note("INFA-UPD-01", "medium", name, f"{has.get('Update Strategy Expression', '?')}: a merge by the target's key")
    elif kind == "Aggregator":
        work.note("INFA-AGG-01", "high", name, "a port that is neither aggregated nor grouped by has its last row's value")
    for f in node.iter("TRANSFORMFIELD"):
        where, expression = f"{name}.{f.get('NAME')}", f.get("EXPRESSION") or ""
        _function_notes(work, "INFA", where, expression, MAPPING_FUNCTIONS, called=True)
        if "/" in expression:
            work.note("INFA-NUM-01", "medium", where, f"a quotient is rounded when it is written: round to {f.get('SCALE')} places, and guard the division")


def _blocks(text: str) -> list:
    """(kind, fields, inner blocks) of a DSX export, nested by BEGIN and END."""
    top: list = []
    stack = [("", {}, top)]
    for line in map(str.strip, text.splitlines()):
        word, _, rest = line.partition(" ")
        if word == "BEGIN":
            block = (rest.strip(), {}, [])
            stack[-1][2].append(block)
            stack.append(block)
        elif word == "END" and len(stack) > 1:
            stack.pop()
        elif word:
            rest = rest.strip()
            stack[-1][1][word] = rest[1:-1].replace('\\"', '"') if len(rest) > 1 and rest[0] == rest[-1] == '"' else rest
    return top


def jobs(text: str) -> Iterator[Work]:
    """Parallel jobs of a DSX export."""
    for kind, fields, records in _blocks(text):
        if kind != "DSJOB":
            continue
        work = Work(DATASTAGE, fields["Identifier"])
        for _, record, inner in (r for r in records if r[0] == "DSRECORD"):
            parts = [f for k, f, _ in inner if k == "DSSUBRECORD"]
            if record.get("OLEType") == "CJobDefn":
                work.parameters += [f["Name"] for f in parts]
            elif record.get("OLEType") in ("CCustomStage", "CTransformerStage"):
                _stage(work, record, record.get("StageType", record["OLEType"]), record.get("Name", ""), parts)
        if work.parameters:
            work.note("DS-PRM-01", "low", work.name, f"parameters: {', '.join(work.parameters)}")
        yield work.done()


def _stage(work: Work, record: dict, kind: str, name: str, parts: list[dict]) -> None:
    work.part(kind, name)
    has = {f.get("Name"): f.get("Value", "") for f in parts}
    if "SelectStatement" in has:
        work.reads += tables_in(has["SelectStatement"])
    if "TableName" in has and record.get("InputPins"):
        work.writes.append(table(has["TableName"]))
        if has.get("WriteMode", "").lower() in UPSERTS:
            work.note("DS-TGT-01", "medium", name, f"{has['WriteMode']} by {has.get('UpsertKeys', '?')}: an upsert by these keys")
    elif "TableName" in has and record.get("OutputPins"):
        work.reads.append(table(has["TableName"]))
    if kind == "PxLookup":
        failure = has.get("LookupFailure", "Fail")
        work.note("DS-LKP-01", "high", name, f"on failure {failure}: {LOOKUP_FAILURE.get(failure, 'to be looked at')}")
    if spread := has.get("Partitioning") or has.get("Method"):
        work.note("DS-PAR-01", "low", name, f"explicit partitioning {spread}: left to the engine")
    for f in parts:
        if derivation := f.get("Derivation"):
            where = f"{name}.{f['Name']}"
            if f.get("Kind") == "StageVariable":
                read = any(f["Name"].replace("StageVar_", "sv_") in g.get("Derivation", "") for g in parts if g is not f)
                work.note("DS-SV-01", "high" if read else "low", where, "a variable of the row before: lag over an explicit order" if read else "a variable of the row before that no column reads: dead code", 2)
            _function_notes(work, "DS", where, derivation, JOB_FUNCTIONS, called=False)


def report(name: str, text: str, subjects: dict[str, str]) -> Work:
    """A Cognos report; ``subjects``: query subject of the package -> table."""
    work = Work(COGNOS, name)
    local = lambda x: x.tag.rpartition("}")[2]
    within = lambda node, tag: (x for x in node.iter() if local(x) == tag)
    root = ET.fromstring(text.encode("utf-8"))
    for q in within(root, "query"):
        own = q.get("name")
        work.parts.append(f"query: {own}")
        work.weight += 2
        for item in within(q, "dataItem"):
            where, expression = f"{own}.{item.get('name')}", next((x.text or "" for x in within(item, "expression")), "")
            work.reads += [subjects[x] for x in re.findall(r"\]\.\[([^\]]+)\]\.\[", expression) if x in subjects]
            if item.get("aggregate") == "calculated":
                work.note("COG-AGG-01", "high", where, f"{expression} is worked out after aggregation: a ratio of sums", 2)
            elif item.get("aggregate") == "average":
                work.note("COG-AGG-02", "medium", where, "a mean of means leans to small groups: expose sum and count")
            if re.search(r"\brank\s*\(", expression, re.I):
                work.note("COG-FN-01", "medium", where, f"{expression}: rank over a partition; say what ties do", 1)
        for f in within(q, "filterExpression"):
            if asked := re.findall(r"\?([^?]+)\?", f.text or ""):
                work.parameters += asked
                work.note("COG-PRM-01", "low", own, f"prompts: {', '.join(asked)}")
    for x in root.iter():
        if local(x) in ("crosstab", "list", "combinationChart", "chart"):
            work.parts.append(f"{local(x)}: {x.get('name')}")
            work.weight += 1
    return work.done()


def programs(texts: Iterable[tuple[str, str]]) -> Iterator[Work]:
    """SAS programs that have steps."""
    for name, text in texts:
        p = lineage.program(name, text)
        if p.steps:
            state, notes = p.readiness
            work = Work(SAS, name, p.inputs, p.outputs, [s.kind for s in p.steps], list(p.variables), weight=p.weight, readiness=state)
            work.notes = [Note(code, lineage.PITFALLS[code][0], f"line {line}", "; ".join(lineage.PITFALLS[code][1:])) for code, line in p.pitfalls] + [Note("SAS-RUN", "info", name, n) for n in notes]
            yield work.done()


@dataclass
class Parc:
    work: list[Work]

    def graph(self) -> Graph:
        """A piece of work needs those that write what it reads."""
        makers = {t: w.name for w in self.work for t in w.writes}
        g = Graph()
        for w in self.work:
            g.add(Model(w.name, build=lambda _: None, needs=sorted({makers[t] for t in w.reads if t in makers} - {w.name})))
        return g

    def waves(self) -> list[list[str]]:
        """What can be carried over together: each wave needs only earlier ones."""
        return self.graph().waves()

    @property
    def sources(self) -> list[str]:
        made = {t for w in self.work for t in w.writes}
        return sorted({t for w in self.work for t in w.reads} - made)

    @property
    def tools(self) -> dict[str, int]:
        return dict(Counter(w.tool for w in self.work))

    def markdown(self) -> str:
        """The estate as a table, in order of waves."""
        wave = {n: i + 1 for i, names in enumerate(self.waves()) for n in names}
        lines = ["| wave | work | tool | weight | level | days | notes |", "|-|-|-|-|-|-|-|"]
        lines += [f"| {wave[w.name]} | {w.name} | {w.tool} | {w.weight} | {w.effort[0]} | {w.effort[1]} | {len(w.notes)} |" for w in sorted(self.work, key=lambda w: (wave[w.name], w.name))]
        return "\n".join(lines)
