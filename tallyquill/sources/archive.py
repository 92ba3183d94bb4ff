"""Sources: archived extraction results, vocabularies, PDF files, sidecars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.functions import fixed as X
from tallyquill.functions import names as N

REGION = "struct<page:int,y_min:int,x_min:int,y_max:int,x_max:int>"
QUESTION = (
    "struct<source_question_id:string,page_start:int,page_end:int,question_text:string,question_type:string,options:array<string>,marks:double,"
    "group_marks:double,group_marks_scope:string,answer:string,worked_solution:string,diagram_required:boolean,"
    f"diagram_region:{REGION},table_regions:array<{REGION}>,depends_on:array<string>,extraction_notes:array<string>,question_key:string>"
)
IMAGE = "struct<source_question_id:string,kind:string,index:int,page:int,image_path:string,cropped:boolean,width:int,height:int>"
ISSUE = "struct<issue_code:string,severity:string,message:string,source_question_id:string>"
SCHEME = "struct<file_name:string,sha256:string,page_count:int,matched:array<string>,unmatched_scheme_ids:array<string>,questions_without_answer:array<string>>"
PAPER = "struct<year:string,term:string,exam_type:string,paper_number:int,school:string,topics:array<string>,source:string>"
ARCHIVE = (
    "source struct<file_name:string,sha256:string,page_count:int,byte_size:bigint>, "
    "run struct<run_id:string,extracted_at:string,extraction_version:string,question_object_version:string,model:string,prompt_sha256:string,input_tokens:int,output_tokens:int>, "
    f"document struct<file_name:string,page_count:int,questions:array<{QUESTION}>,level:string,level_source:string,level_text:string,module:string,module_source:string,module_text:string,paper:{PAPER},marking_scheme:{SCHEME}>, "
    f"issues array<{ISSUE}>, diagrams array<{IMAGE}>, tables array<{IMAGE}>, repairs array<string>"
)


def read_json(spark: SparkSession, path: str, schema: str, fits: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a folder of JSON files: unknown keys are ignored; files that do not fit the schema or the
    condition are reported by path and not fatal."""
    raw = spark.read.schema(f"{schema}, __corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "__corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    raw = raw.withColumn("path", F.col("_metadata.file_path")).withColumn("modified", F.col("_metadata.file_modification_time"))
    good = F.col("__corrupt").isNull() & F.coalesce(fits, F.lit(False))
    return raw.where(good).drop("__corrupt"), raw.where(~good).select("path")


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) results of a folder."""
    return read_json(spark, path, ARCHIVE, F.col("source.sha256").isNotNull() & F.col("document").isNotNull())


def reported(bad: DataFrame, why: str = "not an extraction") -> DataFrame:
    """A line for each file left out, as the tool that reads them words it."""
    return bad.select(F.format_string("  skipped  %s  %s", F.element_at(F.split("path", "/"), -1), F.lit(why)).alias("line"))


def find_extraction_for(schemes: DataFrame, archived: DataFrame) -> DataFrame:
    """(scheme, path): the newest archived file of each scheme's paper, whose name is the paper's safe stem and
    twelve hex digits. schemes: name; archived: path, modified."""
    name = F.element_at(F.split("path", "/"), -1)
    named = archived.where(name.rlike(r"-[0-9a-f]{12}\.json$")).select("path", "modified", F.regexp_replace(name, r"-[0-9a-f]{12}\.json$", "").alias("stem"))
    newest = named.groupBy("stem").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
    asked = schemes.withColumn("stem", N.safe_stem(F.concat(N.scheme_stem(F.col("name")), F.lit(".pdf")))).where("stem is not null")
    return asked.join(newest, "stem").select(F.col("name").alias("scheme"), "path")


def locate(archived: DataFrame, key: str | None = None, paper: str | None = None, qid: str | None = None) -> DataFrame:
    """(path, qid) of a question key, or of a paper's stem prefix and a question id: the first file by path."""
    name = F.element_at(F.split("path", "/"), -1)
    if key is not None:
        if ":" not in key:
            raise ValueError(f"{key!r} is not a question key")
        sha, qid = key.split(":", 1)
        found = archived.where(name.endswith(f"-{sha}.json"))
    elif paper and qid:
        found = archived.where(name.startswith(paper))
    else:
        raise ValueError("give a question key, or a paper and a question id")
    return found.orderBy("path").limit(1).select("path", F.lit(qid).alias("qid"))


def matches(qid: Column, wanted: Column) -> Column:
    """'17' matches 17, 17(a) and 17(b)(i); '17(a)' that part and its own parts."""
    return (qid == wanted) | qid.startswith(F.concat(wanted, F.lit("(")))


MIME = {"pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp"}


def with_mime(files: DataFrame) -> DataFrame:
    """Scanned pages with their MIME type; files of other kinds are an error."""
    types = F.create_map(*(F.lit(x) for pair in MIME.items() for x in pair))
    suffix = F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))
    return files.withColumn("mime", F.coalesce(F.try_element_at(types, suffix), F.raise_error(F.concat(F.lit("not a page scan: "), "name"))))


def resolve_pdf(files: DataFrame, wanted: str | None = None) -> DataFrame:
    """The PDF that a command means: the named one of an inbox (path, name, folder), or the only one."""
    found = files if wanted is None else files.where(F.col("name") == wanted)
    n = found.limit(2).count()
    if n != 1:
        raise ValueError("no such PDF in the inbox" if n == 0 else "several PDFs in the inbox; name one")
    return found


def checked_files(files: DataFrame) -> DataFrame:
    """Files to read, or the error that stops one: (path, error), null for a good file."""
    name, size, head = F.col("path"), F.col("length"), F.col("head")
    return files.select("path", F.when(~F.lower(name).endswith(".pdf"), "not a PDF").when(size == 0, "empty file").when(~head.startswith("%PDF"), "not a PDF").alias("error"))


def diagram_images(images: DataFrame, files: DataFrame, ids: DataFrame) -> DataFrame:
    """(source_question_id, content) of the diagrams of some questions whose file exists. images: id, kind,
    image_path; files: path, content."""
    wanted = images.where("kind = 'diagram'").join(ids, "source_question_id", "left_semi")
    return wanted.join(files, F.col("image_path") == F.col("path")).select("source_question_id", "content")


def questions_of(results: DataFrame) -> DataFrame:
    """doc (paper key), page_count, position from 1, the question's fields."""
    q = results.select(N.paper_key(F.col("source.sha256")).alias("doc"), F.col("document.page_count").alias("page_count"), F.posexplode("document.questions").alias("position", "q"))
    return q.select("doc", "page_count", (F.col("position") + 1).alias("position"), "q.*")


def find_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """path, folder, name, sha256, byte_size, content, modified of every PDF below a folder, any case of
    suffix, empty files left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where("length > 0").select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), name.alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"), "content", F.col("modificationTime").alias("modified"))


def new_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose content is not archived yet, the first by path of equal ones; the rest of those are
    duplicates. Runs before any model is called, since joins are not pushed below a Python stage."""
    first = files.groupBy("sha256").agg(F.min("path").alias("path"))
    return files.join(first, ["sha256", "path"], "left_semi").join(done.select("sha256").distinct(), "sha256", "left_anti")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, after lines that are blank or start with '#', indented ones included; quotes
    double inside quotes; empty and missing cells are ''. A cell holds no line end. The first line of each
    file is its header; files of one folder with different headers are an error."""
    lines = F.filter(F.split(F.col("value"), "\r\n|\n|\r"), lambda x: ~x.rlike(r"^\s*(#|$)"))
    files = spark.read.text(path, wholetext=True).select(lines.alias("lines")).where(F.size("lines") > 0)
    headers = [r[0] for r in files.select(F.get("lines", F.lit(0))).distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers}")
    names = [n.strip().strip('"') for n in headers[0].split(",")] if headers else []
    if not names:
        return spark.createDataFrame([], "none string")
    cells = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"escape": '"'})
    rows = files.select(F.explode(F.slice("lines", F.lit(2), F.size("lines"))).alias("value")).select(cells.alias("c")).select("c.*")
    return rows.select(*(F.coalesce(N.stripped(F.col(f"`{c}`")), F.lit("")).alias(c) for c in rows.columns))


def listed(c: str) -> Column:
    """A ';' list, trimmed, empty entries out."""
    return F.filter(F.transform(F.split(c, ";"), N.stripped), lambda s: s != "")


def read_skills(spark: SparkSession, path: str) -> DataFrame:
    flags = F.create_map(*(F.lit(x) for pair in X.FLAGS.items() for x in pair))
    flag = F.when(F.col("foundation") == "", None).otherwise(F.coalesce(F.try_element_at(flags, F.col("foundation")), F.lit("?")))
    return read_rows(spark, path).withColumns({"foundation": flag, "prerequisites": listed("prerequisites"), "guide_ref": listed("guide_ref")})


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path).withColumn("skills", listed("skills"))


def read_objectives(spark: SparkSession, path: str) -> DataFrame:
    known = F.create_map(*(F.lit(x) for pair in X.FLAGS.items() for x in pair))
    status = F.coalesce(F.try_element_at(known, F.col("nf")), F.raise_error(F.concat(F.lit("unknown objective status "), F.col("nf"))))
    return read_rows(spark, path).select(F.concat_ws("-", "part", "obj").alias("ref"), "part", "strand", "unit_no", "unit", "text", status.alias("status"), "remarks")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    rows = read_rows(spark, path)
    levels = {d: F.col(d).cast("int") for d in X.DIMENSIONS}
    return rows.withColumns({**levels, "skills": listed("skills"), "errors": listed("errors"), "status": F.when(F.col("status") == "", "draft").otherwise(F.col("status"))})


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """folder, stem, fields of every '<stem>.meta.txt'."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.meta.txt")
    p = F.col("_metadata.file_path")
    return texts.select(F.regexp_replace(p, "/[^/]*$", "").alias("folder"), F.regexp_replace(F.element_at(F.split(p, "/"), -1), r"\.meta\.txt$", "").alias("stem"), N.parse_sidecar(F.col("value")).alias("fields"))
