"""Maps of content, concept index, canonical names and link resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import Scratch
from ..sources.sinks import AUTO_NOTE, head
from .ordered import PART_BYTES, assembled


#: Courses in their order of study; others come after them, by name.
COURSE_ORDER = ["Pre-Program- Before You Start", "Month 1", "Month 2", "Month 3", "Month 4", "Month 5", "Month 6", "Automation Tutorials", "Resource Library"]


def lines_in_order(order: list[str], line: str) -> Column:
    """The lines of one page, joined in a total order; a page is one row, as it is one file."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda s: s[line]), "\n")


def page_path(folder: Column, title: Column) -> Column:
    """A generated page's path: in its folder, with a leading _."""
    return F.concat(folder, F.lit("/_"), X.safe_filename(title), F.lit(".md"))


def numbered(index: Column, title: Column) -> Column:
    """"07. Title", as links show a lesson."""
    return F.concat(F.format_string("%02d", index.cast("int")), F.lit(". "), X.clean_title(title))


def _course_link(course: Column) -> Column:
    return F.concat(F.lit("> Course: [["), course, F.lit("/_"), X.safe_filename(course), F.lit("|"), course, F.lit("]]\n\n"))


def _module_page(course: Column, module_dir: Column, title: Column, body: Column) -> list[Column]:
    fields = [("vault_schema", F.lit(1), "raw"), ("title", title, "text"), ("type", F.lit("module-moc"), "text"), ("moc_type", F.lit("module"), "text"), ("course", course, "text"), ("module", title, "text")]
    text = F.concat(head(fields), F.lit(f"\n{AUTO_NOTE}\n\n# "), title, F.lit("\n\n"), _course_link(course), body, F.lit("\n"))
    return [page_path(F.concat(course, F.lit("/"), module_dir), title).alias("path"), text.alias("text")]


def module_pages(lessons: DataFrame) -> DataFrame:
    """course, module_dir, path and text of each module's page: its lessons in order, with their summaries.

    lessons: course, module_dir, module_title, lesson_index, lesson_title, path, summary
    and lesson_dir. The first lesson names the module.
    """
    order = ["lesson_index", "lesson_title", "at"]
    line = F.concat(F.lit("- "), X.wikilink(F.col("path"), numbered(F.col("lesson_index"), F.col("lesson_title"))), F.when(F.coalesce("summary", F.lit("")) != "", F.concat(F.lit("\n    - "), F.col("summary"))).otherwise(F.lit("")))
    rows = lessons.withColumns({"line": line, "at": F.split("lesson_dir", "/")})
    pages = rows.groupBy("course", "module_dir").agg(F.min_by("module_title", F.struct(*order)).alias("title"), lines_in_order(order, "line").alias("body"))
    return pages.select("course", "module_dir", *_module_page(F.col("course"), F.col("module_dir"), F.col("title"), F.concat(F.lit("## Lessons\n\n"), F.col("body"))))


def stub_pages(modules: DataFrame, lessons: DataFrame) -> DataFrame:
    """Pages of the module folders (course, module_dir) of known courses that hold no lesson."""
    empty = without_lessons(modules.join(lessons.select("course").distinct(), "course", "left_semi"), lessons, ["course", "module_dir"])
    return empty.select("course", "module_dir", *_module_page(F.col("course"), F.col("module_dir"), X.strip_index(F.col("module_dir")), F.lit("_No lessons indexed for this module yet._\n")))


def course_pages(lessons: DataFrame, root: str) -> DataFrame:
    """course, path and text of each course's page: its modules, each once, in order of index, folder and title."""
    modules = lessons.select("course", "module_index", "module_dir", "module_title").distinct()
    target = page_path(F.concat_ws("/", "course", "module_dir"), F.col("module_title"))
    rows = modules.withColumn("line", F.concat(F.lit("- "), X.wikilink(target, F.col("module_title"))))
    pages = rows.groupBy("course").agg(lines_in_order(["module_index", "module_dir", "module_title"], "line").alias("body"))
    c = F.col("course")
    fields = [("vault_schema", F.lit(1), "raw"), ("title", c, "text"), ("type", F.lit("course-moc"), "text"), ("course", c, "text")]
    text = F.concat(head(fields), F.lit("\n# "), c, F.lit(f"\n\n> [[{root}]] › **"), c, F.lit("**\n\n## Modules\n\n"), F.col("body"), F.lit("\n"))
    return pages.select("course", page_path(c, c).alias("path"), text.alias("text"))


def custom_order(name: Column, order: list[str]) -> Column:
    """Place in a given list, 999 for others."""
    at = F.array_position(F.array(*map(F.lit, order)), name)
    return F.when(at > 0, at - 1).otherwise(F.lit(999)).cast("int")


def concept_path(name: Column) -> Column:
    return F.concat(F.lit("Concepts/"), X.safe_filename(name), F.lit(".md"))


def root_page(lessons: DataFrame, concepts: DataFrame, title: str, order: list[str] | None = None) -> DataFrame:
    """One row, path and text: courses in their given order, then concepts by name."""
    courses = lessons.select("course").distinct().select(F.lit(0).alias("part"), custom_order(F.col("course"), order or COURSE_ORDER).alias("at"), F.col("course").alias("name"))
    names = concepts.select(F.lit(1).alias("part"), F.lit(0).alias("at"), F.col("concept").alias("name")).distinct()
    target = F.when(F.col("part") == 0, page_path(F.col("name"), F.col("name"))).otherwise(concept_path(F.col("name")))
    rows = courses.unionByName(names).withColumn("line", F.concat(F.lit("- "), X.wikilink(target, F.col("name"))))
    body = rows.groupBy("part").agg(lines_in_order(["at", "name"], "line").alias("body")).agg(*(F.coalesce(F.max(F.when(F.col("part") == i, F.col("body"))), F.lit("")).alias(f"b{i}") for i in (0, 1)))
    fields = [("vault_schema", F.lit(1), "raw"), ("title", F.lit(title), "text"), ("type", F.lit("vault-root"), "text")]
    text = F.concat(head(fields), F.lit(f"\n# {title}\n\n> Root of the vault. Each course section is a MOC.\n\n## Sections\n\n"), F.col("b0"), F.lit("\n\n## Concepts\n\n"), F.col("b1"), F.lit("\n"))
    return body.select(F.lit(f"{title}.md").alias("path"), text.alias("text"))


_CONCEPT_ORDER = ["course", "module_index", "lesson_index", "at", "pos"]


def concept_lines(mentioned: DataFrame, lessons: DataFrame, key: str) -> DataFrame:
    """canonical, line and the columns of its order: a row for each mention of a concept by a lesson."""
    named = mentioned.join(canonical_casing(mentioned), F.lower("concept") == F.col("lowered")).join(lessons, key)
    shown = F.concat_ws(" › ", F.col("course"), F.col("module_title"), X.clean_title(F.col("lesson_title")))
    rows = named.withColumns({"line": F.concat(F.lit("- "), X.wikilink(F.col("path"), shown)), "at": F.split("lesson_dir", "/")})
    return rows.select("canonical", *_CONCEPT_ORDER, "line")


def concept_parts(mentioned: DataFrame, lessons: DataFrame, key: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """The bodies of concept_pages in parts of known places, so that no row or task holds a concept that most lessons name."""
    rows = concept_lines(mentioned, lessons, key).withColumnRenamed("at", "folder")
    return assembled(rows, ["canonical"], ["course", "module_index", "lesson_index", "folder", "pos"], "line", Scratch(lessons.sparkSession, "concepts"), part_bytes)


def concept_pages(mentioned: DataFrame, lessons: DataFrame, key: str) -> DataFrame:
    """canonical, lesson_count, path and text of each concept's page: the lessons that name it, in order of course and indexes.

    A lesson that names a concept twice is there twice. lessons: key, course,
    module_title, module_index, lesson_index, lesson_title, lesson_dir and path.
    """
    pages = concept_lines(mentioned, lessons, key).groupBy("canonical").agg(F.count("*").alias("lesson_count"), lines_in_order(_CONCEPT_ORDER, "line").alias("body"))
    c, n = F.col("canonical"), F.col("lesson_count")
    fields = [("vault_schema", F.lit(1), "raw"), ("title", c, "text"), ("type", F.lit("concept"), "text"), ("tags", F.array(F.lit("concept")), "list"), ("lesson_count", n, "raw")]
    text = F.concat(head(fields), F.lit("\n# "), c, F.lit("\n\n> Concept referenced in "), n.cast("string"), F.when(n == 1, F.lit(" lesson")).otherwise(F.lit(" lessons")), F.lit(".\n\n## Lessons\n\n"), F.col("body"), F.lit("\n"))
    return pages.select("canonical", "lesson_count", concept_path(c).alias("path"), text.alias("text"))


def without_lessons(modules: DataFrame, lessons: DataFrame, keys: list[str]) -> DataFrame:
    return modules.join(lessons.select(*keys).distinct(), keys, "left_anti")


def mentions(rows: DataFrame, key: str, lists: str, order: list[Column]) -> DataFrame:
    """One row per mention: key, seq (place of the row), pos, concept."""
    return rows.select(key, F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))).alias("seq"), F.posexplode(lists).alias("pos", "concept")).filter(F.coalesce("concept", F.lit("")) != "")


def canonical_casing(mentioned: DataFrame) -> DataFrame:
    """lowered, canonical: the casing of each concept that is met first."""
    return mentioned.groupBy(F.lower("concept").alias("lowered")).agg(F.min_by("concept", F.struct("seq", "pos")).alias("canonical"))


def concept_index(mentioned: DataFrame, key: str) -> DataFrame:
    """canonical, lesson_count (mentions, not distinct rows), and the rows' keys in order."""
    named = mentioned.join(canonical_casing(mentioned), F.lower("concept") == F.col("lowered"))
    return named.groupBy("canonical").agg(F.count("*").alias("lesson_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", key))), lambda s: s[key].cast("string")), ",").alias("lessons"))


def frequency(mentioned: DataFrame) -> DataFrame:
    """concept, n; by falling n, then name."""
    return mentioned.groupBy("concept").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "concept")


def inventory_paths(notes: DataFrame) -> DataFrame:
    """kind (concept or tag), name, n and the paths that name it, by path parts; names without outer blanks, blank ones go.

    notes: path and head (a map of lists).
    """
    each = lambda kind, key: notes.select("path", F.lit(kind).alias("kind"), F.explode(F.try_element_at("head", F.lit(key))).alias("name"))
    rows = each("concept", "concepts").unionByName(each("tag", "tags")).withColumn("name", X.strip(F.col("name"))).filter(F.col("name") != "")
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.split("path", "/").alias("at"), "path"))), lambda s: s["path"])
    return rows.groupBy("kind", "name").agg(F.count("*").alias("n"), listed.alias("paths"))


def prompt_lines(inventory: DataFrame) -> DataFrame:
    """kind, place and line of the prompt's inventory: names by falling count, then name, with their counts. inventory: kind, name, n."""
    w = Window.partitionBy("kind").orderBy(F.desc("n"), "name")
    quoted = F.when(F.col("name").contains("'") & ~F.col("name").contains('"'), F.concat(F.lit('"'), F.replace("name", F.lit("\\"), F.lit("\\\\")), F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(F.replace("name", F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))
    return inventory.select("kind", F.row_number().over(w).alias("place"), F.concat(F.lit("  "), quoted, F.lit(": "), F.col("n").cast("string")).alias("line"))


def related(mentioned: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """key and its links to concepts that have a page (concept, path); others are dropped."""
    linked = mentioned.join(targets, "concept").withColumn("link", X.wikilink(F.col("path"), F.col("concept")))
    return linked.groupBy(key).agg(F.count("*").alias("n_links"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "link"))), lambda s: s["link"]), ", ").alias("links"))


def mapping_rows(answers: DataFrame, text: str = "text") -> DataFrame:
    """kind (concept or tag), variant, canonical of a model's answer, without outer blanks and empty sides; of one variant the last counts."""
    j = F.from_json(X.json_object(F.col(text)), "concepts map<string,string>, tags map<string,string>")
    both = [answers.select(F.lit(kind).alias("kind"), F.posexplode(F.map_entries(j[key])).alias("at", "e")) for kind, key in (("concept", "concepts"), ("tag", "tags"))]
    rows = both[0].unionByName(both[1]).select("kind", "at", X.strip(F.col("e.key")).alias("variant"), X.strip(F.col("e.value")).alias("canonical"))
    return rows.filter((F.col("variant") != "") & (F.col("canonical") != "")).groupBy("kind", "variant").agg(F.max_by("canonical", "at").alias("canonical"))


def merges(mapping: DataFrame, first: int | None = None) -> DataFrame:
    """Entries that change a name; optionally the first so many, by variant."""
    rows = mapping.filter(F.col("variant") != F.col("canonical"))
    return rows if first is None else rows.orderBy("variant").limit(first)


def apply_canonical(rows: DataFrame, key: str, lists: str, mapping: DataFrame) -> DataFrame:
    """key, old and new lists, n_replaced (before repeats go), changed.

    mapping: variant, canonical. Names are looked up without outer blanks; those
    without an entry stay; empty ones go; the first place of a repeat stays.
    """
    each = rows.select(key, F.posexplode_outer(lists).alias("pos", "name")).withColumn("bare", X.strip(F.col("name"))).join(mapping.select("variant", "canonical"), F.col("bare") == F.col("variant"), "left")
    each = each.withColumn("to", F.coalesce("canonical", "bare"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("pos", c)))), lambda s: s[c])
    out = each.groupBy(key).agg(ordered("name").alias("old"), F.array_distinct(F.filter(ordered("to"), lambda x: x != "")).alias("new"), F.sum((F.col("to") != F.col("bare")).cast("long")).alias("n"))
    return out.select(key, "old", "new", F.coalesce("n", F.lit(0)).alias("n_replaced"), (~F.col("old").eqNullSafe(F.col("new"))).alias("changed"))


def canonical_stats(concepts: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """files_changed (by either list), concept_replacements and tag_replacements, of apply_canonical's rows for both lists."""
    both = concepts.select(key, "n_replaced", "changed").join(tags.select(key, F.col("n_replaced").alias("t"), F.col("changed").alias("u")), key)
    return both.agg(F.count_if(F.col("changed") | F.col("u")).alias("files_changed"), F.coalesce(F.sum("n_replaced"), F.lit(0)).alias("concept_replacements"), F.coalesce(F.sum("t"), F.lit(0)).alias("tag_replacements"))


def orphans(stubs: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Stub pages (column name) that no row mentions, compared in normal form."""
    used = mentioned.select(X.normalize_concept(F.col("concept")).alias("k")).distinct()
    return stubs.withColumn("k", X.normalize_concept(F.col("name"))).join(used, "k", "left_anti").drop("k")


def resolve_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """links (page, target) with `resolved`: a file or folder has that path, with or without .md, or, for a target without a slash, a file that name.

    Equi-joins on distinct targets; no pair of a link and a file is tried.
    """
    wanted = links.select("target").distinct()
    parts = F.split("path", "/")
    folders = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("target"))
    notes = files.filter(F.col("path").endswith(".md")).select(F.regexp_replace("path", r"\.md$", "").alias("p"))
    names = notes.select(X.basename(F.col("p")).alias("target"))
    by_path = wanted.join(folders.unionByName(notes.select(F.col("p").alias("target"))).distinct(), "target", "left_semi")
    by_name = wanted.filter(~F.col("target").contains("/")).join(names.distinct(), "target", "left_semi")
    found = by_path.union(by_name).distinct().withColumn("ok", F.lit(True))
    return links.join(found, "target", "left").select("page", "target", F.coalesce("ok", F.lit(False)).alias("resolved"))


def page_links(pages: DataFrame) -> DataFrame:
    """page and target (without outer blanks) of each link in pages (path, text)."""
    return pages.select(F.col("path").alias("page"), F.explode(X.wikilinks(F.col("text"))).alias("t")).select("page", X.strip(F.col("t")).alias("target"))


def link_report(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("page").agg(F.count("*").alias("n_links"), F.count_if(~F.col("resolved")).alias("n_broken"))


def link_ratio(resolved: DataFrame) -> DataFrame:
    """checked, broken and their ratio over all pages."""
    got = resolved.agg(F.count("*").alias("checked"), F.count_if(~F.col("resolved")).alias("broken"))
    return got.withColumn("ratio", F.when(F.col("checked") > 0, F.round(F.col("broken") / F.col("checked"), 4)).otherwise(F.lit(0.0)))


#: Notes of which links to replaced names are looked for (a sampling check).
SAMPLE = 50


def stale_links(notes: DataFrame, mapping: DataFrame, first: int | None = SAMPLE) -> DataFrame:
    """path of the notes whose body links to a name that the mapping replaces; of the first notes by path parts, or of all (None).

    Links and names are compared in lower case without outer blanks and a leading
    concepts/; a name replaced by its own other casing is none. The head is no body.
    """
    name = lambda c: F.lower(X.strip(c))
    variants = mapping.filter(name(F.col("variant")) != name(F.col("canonical"))).select(name(F.col("variant")).alias("name")).distinct()
    some = notes.select("path", "text")
    if first is not None:
        some = some.orderBy(F.split("path", "/")).limit(first)
    body = F.regexp_replace("text", r"(?s)\A---\s*\n.*?\n---\s*\n", "")
    links = some.select("path", F.explode(X.wikilinks(body)).alias("t")).select("path", F.regexp_replace(name(F.col("t")), "^concepts/", "").alias("name"))
    return links.join(variants, "name", "left_semi").select("path").distinct()
