"""File names to extensions and languages, and the paths that are never analysed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Languages by extension.
LANGUAGES = {
    ".py": "Python",
    ".java": "Java",
    ".js": "JavaScript",
    ".jsx": "React JSX",
    ".ts": "TypeScript",
    ".tsx": "React TSX",
    ".c": "C",
    ".cpp": "C++",
    ".cs": "C#",
    ".h": "Header",
    ".hpp": "C++ Header",
    ".go": "Go",
    ".rs": "Rust",
    ".rb": "Ruby",
    ".php": "PHP",
    ".swift": "Swift",
    ".kt": "Kotlin",
    ".sh": "Shell",
    ".html": "HTML",
    ".css": "CSS",
    ".sql": "SQL",
}
OTHER_LANGUAGE = "Text"

# Directory names that hold libraries, build output or tool data.
SKIPPED_SEGMENTS = [
    "venv", ".venv", "env", ".env", "__pycache__", ".eggs",
    "site-packages", "dist-packages", "pip", "setuptools", "pkg_resources",
    "distutils", "_distutils_hack",
    "node_modules", ".npm", ".yarn", ".pnp",
    "target", ".gradle", ".m2",
    "Pods", "vendor", "bundle", "cargo", ".cargo",
    "build", "dist", "bin", "obj", "out", ".next", ".nuxt", "__sapper__",
    ".git", ".svn", ".hg", ".idea", ".vscode", ".vs",
    "__MACOSX", ".DS_Store",
    "bower_components",
]
# Fragments that mark a segment as library data wherever they occur.
SKIPPED_FRAGMENTS = [
    "site-packages", "dist-packages", "dist-info", "egg-info",
    "pip-", "setuptools", "pkg_resources", "__pycache__", ".egg-link",
]


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(F.translate(path, "\\", "/"), "/"), -1)


def known_extension(name: Column) -> Column:
    """Lower-case extension when it is a known source extension, else empty."""
    ext = F.regexp_extract(F.lower(name), r"(\.[^.]+)\z", 1)
    return F.when(ext.isin(*LANGUAGES), ext).otherwise("")


def language(name: Column) -> Column:
    """Language of a file name; ``Text`` when the extension is not known."""
    pairs = [F.lit(v) for item in LANGUAGES.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), known_extension(name)), F.lit(OTHER_LANGUAGE))


def is_skipped(path: Column) -> Column:
    """True for paths inside library, build or tool directories."""
    segments = F.split(F.translate(path, "\\", "/"), "/")
    named = F.arrays_overlap(segments, F.array(*[F.lit(s) for s in SKIPPED_SEGMENTS]))
    # A fragment cannot contain a slash, so looking in the whole path is enough.
    fragment = path.contains(SKIPPED_FRAGMENTS[0])
    for text in SKIPPED_FRAGMENTS[1:]:
        fragment = fragment | path.contains(text)
    return named | fragment


def in_hidden_directory(path: Column) -> Column:
    """True when a directory on the path starts with a dot."""
    return F.translate(path, "\\", "/").rlike(r"(?:\A|/)\.[^/]*/")


def source_rows(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Any (path, content) rows as file rows with name, extension and language."""
    name = file_name(F.col(path))
    return files.select(
        "*",
        name.alias("fname"),
        known_extension(name).alias("ext"),
        language(name).alias("lang"),
    ) if path == "path" and content == "content" else source_rows(
        files.withColumnRenamed(path, "path").withColumnRenamed(content, "content")
    )


def only_sources(files: DataFrame) -> DataFrame:
    """Keep visible files with a source extension outside skipped directories."""
    name = file_name(F.col("path"))
    return files.filter(
        ~is_skipped(F.col("path"))
        & (name != "")
        & ~name.startswith(".")
        & (known_extension(name) != "")
    )


def file_key(*frames) -> list[str]:
    """The columns that tell files apart: the path, and the archive where all tables have one."""
    return ["archive", "path"] if all("archive" in f.columns for f in frames) else ["path"]


def join_files(left, right, how: str = "inner"):
    """Join on the file key; a missing archive equals a missing archive. Right columns of the left's names are dropped."""
    key = file_key(left, right)
    kept = [c for c in right.columns if c not in left.columns]
    other = right.select(*[F.col(k).alias(f"_key_{k}") for k in key], *[F.col(f"`{c}`") for c in kept])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return left.join(other, same, how).drop(*[f"_key_{k}" for k in key])
