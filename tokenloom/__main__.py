"""Command line: ``python -m tokenloom <command> --help``."""

from __future__ import annotations

import argparse

from tokenloom.plans import mix as mixes, prepare, sweep
from tokenloom.plans.jobs import DOWNLOAD, TOKENIZE, load_settings
from tokenloom.session import build_session
from tokenloom.sources.token_table import read_tokens


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tokenloom")
    commands = top.add_subparsers(dest="command", required=True)
    for name in (DOWNLOAD, TOKENIZE):
        command = commands.add_parser(name, help=f"{name} the datasets of a job file")
        command.add_argument("--config", required=True)
        command.add_argument("--only", nargs="+")
        command.add_argument("--max-samples", type=int)
        command.add_argument("--tokenizer")
        command.add_argument("--output-dir", help="raw folders" if name == DOWNLOAD else "token table")
        command.add_argument("--dry-run", action="store_true")
        if name == DOWNLOAD:
            command.add_argument("--tokenized-dir", help="token table")
            command.add_argument("--no-tokenize", action="store_true", help="only download")
            command.add_argument("--streaming", action=argparse.BooleanOptionalAction)
        else:
            command.add_argument("--input-dir", help="raw folders")
            command.add_argument("--max-seq-length", type=int)
    command = commands.add_parser("validate-mix", help="report on a data mix over a token table")
    command.add_argument("config")
    command.add_argument("--tokens", required=True)
    command = commands.add_parser("feed", help="write the samples of every training worker")
    command.add_argument("config")
    command.add_argument("--tokens", required=True)
    command.add_argument("--output", required=True)
    command.add_argument("--draws", type=int, required=True)
    command.add_argument("--workers", type=int, required=True)
    command.add_argument("--skip", type=int, default=0)
    command.add_argument("--samples-done", type=int, help="resume: samples that all workers have supplied together")
    command.add_argument("--batch-size", type=int)
    command.add_argument("--num-workers", type=int, help="workers of a rank, if there are several ranks")
    command = commands.add_parser("pending-evals", help="list checkpoints without results")
    command.add_argument("folder", nargs="?", help="folder of checkpoints")
    command.add_argument("--config", help="evaluation settings that name a model, checkpoints or their folder")
    command.add_argument("--model", help="this model alone")
    command.add_argument("--results", help="folder with one result folder per evaluated checkpoint")
    command.add_argument("--last", type=int)
    command.add_argument("--force", action="store_true")
    return top


def job_settings(args: argparse.Namespace) -> dict:
    """The job file, with the folders that the command line names instead."""
    if args.command == DOWNLOAD:
        folders = {"input_dir": args.output_dir, "output_dir": args.tokenized_dir, "tokenize": False if args.no_tokenize else None}
    else:
        folders = {"input_dir": args.input_dir, "output_dir": args.output_dir}
    return load_settings(args.config) | {k: v for k, v in folders.items() if v is not None}


def job_overrides(args: argparse.Namespace) -> dict:
    """What the command line says for every entry."""
    names = ("max_samples", "tokenizer", "streaming", "max_seq_length")
    return {n: v for n in names if (v := getattr(args, n, None)) is not None}


def show_all(df) -> None:
    """Every row, one line each."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    if args.command in (DOWNLOAD, TOKENIZE):
        listed = prepare.run_jobs(
            spark, job_settings(args), args.command, only=args.only, overrides=job_overrides(args), dry_run=args.dry_run
        )
        show_all(listed.select("name", "raw_dir", "limit", "mode"))
    elif args.command == "pending-evals":
        settings = load_settings(args.config) if args.config else {"checkpoint_dir": args.folder} if args.folder else {}
        given = {"output_dir": args.results, "last": args.last}
        settings |= {k: v for k, v in given.items() if v is not None}
        show_all(sweep.pending_checkpoints(spark, settings, args.model, args.force).select("name", "path", "results"))
    else:
        mix = mixes.Mix.from_yaml(args.config)
        entries = mix.frame(spark)
        tokens = read_tokens(spark, args.tokens, mix.datasets)
        if args.command == "validate-mix":
            show_all(mixes.validate_mix(entries, tokens, mix.block_len).orderBy("ds_idx"))
        else:
            mixes.training_feed(
                entries, tokens, mix.block_len, draws=args.draws, workers=args.workers, seed=mix.seed,
                skip=args.skip, batch_size=args.batch_size, samples_done=args.samples_done,
                num_workers=args.num_workers,
            ).write.partitionBy("worker").parquet(args.output)


if __name__ == "__main__":
    main()
