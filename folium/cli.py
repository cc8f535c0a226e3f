"""Command line: build the corpus, build questions and answers, compare version folders."""

from __future__ import annotations

import argparse
import importlib
import logging
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import functions as F

from folium.operators import questions
from folium.plans import pipeline, reports
from folium.runtime import release, session
from folium.sources import files, jsonl, settings


#: Differing paths shown per pair of versions.
DIFFERING = 5


def _by(df, column: str) -> dict:
    return {r[column]: r["n"] for r in reports.counts_by(df, column).collect()}


def build_corpus(args: argparse.Namespace) -> None:
    spark = session("folium-corpus")
    sources = settings.load_sources(args.config, args.docs)
    config = settings.load_pipeline(args.config)
    corpus, documents, pairs = pipeline.build_corpus(spark, sources, str(args.docs), config, parity=args.parity)
    out = Path(args.out_dir)
    jsonl.write_jsonl(corpus, str(out / "corpus.jsonl"), [F.split("doc_id", "/"), "chunk_index"], args.single_file)
    rows = jsonl.read_jsonl(spark, str(out / "corpus.jsonl"), jsonl.CORPUS_COLUMNS).persist()
    jsonl.write_report({r["project"]: r.asDict() for r in reports.split_report(documents).orderBy("project").collect()}, out / "split_report.json")
    counts = reports.corpus_counts(rows).first()
    marked = rows.where("duplicate_of is not null").orderBy(F.split("doc_id", "/"), "chunk_index").limit(reports.EXAMPLES)
    examples = [r.asDict() for r in marked.select("id", "duplicate_of", "source_path", "section_path").collect()]
    jsonl.write_report({"total_chunks": counts["total_chunks"], "marked": counts["marked_duplicates"], "clusters": counts["clusters"], "examples": examples}, out / "dedup_report.json")
    near = [r.asDict() for r in reports.near_report(pairs, rows).orderBy("a", "b").limit(reports.EXAMPLES).collect()]
    active = {"active": config.dedup.near_duplicate_check, "threshold": config.dedup.near_duplicate_threshold, "pairs": pairs.count(), "examples": near}
    jsonl.write_report(active, out / "near_dedup_report.json")
    manifest = {
        "generated_at_utc": datetime.now(timezone.utc).isoformat(), "projects": len(sources), "chunks": counts["total_chunks"], "by_split": _by(rows, "split"),
        "by_content_type": _by(rows, "content_type"), "low_signal": counts["low_signal"], "token_rule": "words and single symbols",
        "versions": {p: s.canonical_version for p, s in sources.items()},
    }
    jsonl.write_report(manifest, out / "manifest.json")
    print(f"{counts['total_chunks']} chunks in {out / 'corpus.jsonl'}")
    release(spark)


def build_qa(args: argparse.Namespace) -> None:
    spark = session("folium-qa")
    out = Path(args.out_dir)
    if not (out / "corpus.jsonl").exists():
        raise SystemExit(f"{out / 'corpus.jsonl'} is missing; run build-corpus first")
    config = settings.load_pipeline(args.config)
    corpus = jsonl.read_jsonl(spark, str(out / "corpus.jsonl"), jsonl.CORPUS_COLUMNS)
    factory = None
    if args.client and not args.no_llm:
        module, _, name = args.client.partition(":")
        factory = questions.usable_factory(getattr(importlib.import_module(module), name))
    checked, final, failed = pipeline.build_qa(corpus, config.qa.max_pairs_per_document, factory, config.qa.llm_model)
    jsonl.write_jsonl(final, str(out / "qa.jsonl"), ["doc_id", "pick"], args.single_file)
    report: dict = {"llm_errors": {}}
    for r in reports.qc_counts(checked, final, failed).collect():
        report.setdefault(r["counter"], {})[r["value"]] = r["n"]
    jsonl.write_report(report, out / "qc_report.json")
    release(spark)


def compare_versions(args: argparse.Namespace) -> None:
    spark = session("folium-compare")
    for project, s in settings.load_sources(args.config, args.docs).items():
        folder = Path(args.docs) / project
        for other in sorted(p.name for p in folder.iterdir() if p.is_dir() and p.name != s.canonical_version):
            sides = []
            for version in (s.canonical_version, other):
                rows = files.with_digest(files.read_folders(spark, {(project, version): str(folder / version)}, str(args.docs)))
                sides.append(rows.select(files.inner_path("relative_path").alias("path"), "sha256"))
            compared = files.compare(*sides, "path", "sha256").persist()
            counts = _by(compared, "status")
            same = set(counts) <= {"same"}
            print(f"{project}: {s.canonical_version} and {other}:", f"identical, {counts.get('same', 0)} files" if same else counts)
            for r in compared.where("status = 'different'").orderBy("path").limit(DIFFERING).collect():
                print(f"  different: {r['path']}")
            compared.unpersist()


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="folium")
    top.add_argument("--config", default="config.yaml")
    top.add_argument("--docs", default="docs_raw")
    top.add_argument("--env", default=".env", help="file of KEY=value lines for the environment, if there")
    top.add_argument("--verbose", action="store_true", help="log what every step read and made")
    sub = top.add_subparsers(required=True)
    for name, fn in (("build-corpus", build_corpus), ("build-qa", build_qa), ("compare-versions", compare_versions)):
        p = sub.add_parser(name)
        p.add_argument("--out-dir", default="out")
        p.add_argument("--single-file", action="store_true")
        if fn is build_corpus:
            p.add_argument("--parity", action="store_true", help="order equal components by a seeded shuffle of their list (small runs)")
        if fn is build_qa:
            p.add_argument("--client", help="module:callable that makes an LLM client")
            p.add_argument("--no-llm", action="store_true")
        p.set_defaults(run=fn)
    args = top.parse_args(argv)
    settings.load_env(args.env)
    if args.verbose:
        logging.basicConfig(level=logging.WARNING)
        logging.getLogger("folium").setLevel(logging.INFO)
    args.run(args)


if __name__ == "__main__":
    main()
