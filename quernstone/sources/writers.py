"""Writers: manifests, published datasets, sheets, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_segments(segments: DataFrame, path: str) -> None:
    """One folder of JSON a source; only the sources that are there are overwritten. Not to the path that is being read."""
    (segments.repartition("source_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").json(path))


def publish(rows: DataFrame, path: str) -> None:
    """Rows with config and split as Parquet, in folders by both."""
    rows.repartition("config", "split").write.mode("overwrite").partitionBy("config", "split").parquet(path)


def check_published(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(config, split, n, missing): rows of each split and the columns that they lack."""
    lost = ",".join(c for c in columns if c not in rows.columns)
    return rows.groupBy("config", "split").agg(F.count("*").alias("n")).withColumn("missing", F.lit(lost))


def sheet(rows: DataFrame, path: str) -> None:
    """A CSV that spreadsheets read: header, all fields quoted, quotes doubled."""
    rows.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def review_records(segments: DataFrame) -> DataFrame:
    """What a reviewer sees of each clip: labels with defaults, a link to the second, flags as text."""
    url = F.when(F.col("source_url") != "", F.concat("source_url", F.lit("&t="), F.col("start_s").cast("int").cast("string"))).otherwise("")
    return segments.select(
        "id", "language", "speaker_id", "transcript", F.coalesce(F.nullif("emotion", F.lit("")), F.lit("neutral")).alias("emotion"), F.coalesce(F.nullif("style", F.lit("")), F.lit("narrative")).alias("style"), F.round("duration_s", 2).alias("duration_s"), "status", F.array_join("flags", ", ").alias("flags"), url.alias("link")
    )


def review_page(segments: DataFrame, title: str = "Review") -> str:
    """A static page with the records embedded as JSON, for as many clips as one reviewer looks at."""
    rows = [json.loads(r) for r in review_records(segments).toJSON().toLocalIterator()]
    data = json.dumps(rows, ensure_ascii=False).replace("</", "<\\/")
    cells = "${['id','language','speaker_id','transcript','emotion','style','status','flags'].map(k=>`<td>${esc(r[k])}</td>`).join('')}"
    return (
        f'<!doctype html><meta charset="utf-8"><title>{title}</title><table id="t"></table><script>const rows={data};'
        "const esc=x=>String(x??'').replace(/[&<>]/g,c=>({'&':'&amp;','<':'&lt;','>':'&gt;'}[c]));"
        f"document.getElementById('t').innerHTML=rows.map(r=>`<tr>{cells}</tr>`).join('');</script>"
    )


def report(frames: dict[str, DataFrame]) -> str:
    """A JSON report of small aggregates, by name."""
    return json.dumps({name: [json.loads(r) for r in df.toJSON().toLocalIterator()] for name, df in frames.items()}, ensure_ascii=False, indent=2)


def merged_report(old: str, new: dict) -> str:
    """An existing report with new keys put in and others kept."""
    return json.dumps({**(json.loads(old) if old.strip() else {}), **new}, ensure_ascii=False, indent=2)


def card(stats: DataFrame, title: str) -> str:
    """A dataset card: a Markdown table of the statistics by language."""
    names = stats.columns
    lines = [f"# {title}", "", "| " + " | ".join(names) + " |", "|" + " - |" * len(names)]
    for r in stats.toLocalIterator():
        lines.append("| " + " | ".join("" if v is None else str(v) for v in r) + " |")
    return "\n".join(lines) + "\n"


def final_selection(records: DataFrame, stats: dict[str, DataFrame], path: str) -> None:
    """The selected records as Parquet by language under path/records, and the small tables of statistics as one JSON text under path/stats."""
    records.repartition("language").write.mode("overwrite").partitionBy("language").parquet(f"{path}/records")
    records.sparkSession.createDataFrame([(report(stats),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stats", lineSep="\n")


def evaluation(figures: dict[str, dict[str, object] | None]) -> str:
    """The card's section on evaluation: a line for each evaluation that there is, in this order; none gives no section."""

    def line(name: str, **said: str | None) -> str:
        return f"- **{name}**: {', '.join(f'{k.replace("_", " ")} {v}' for k, v in said.items() if v is not None)}."

    def told(form: str, value: object) -> str | None:
        return None if value is None else format(value, form)

    f = {k: v for k, v in figures.items() if v}
    lines = []
    if s := f.get("speaker"):
        lines.append(line("Single speaker", same_speaker_cosine=told(".2f", s.get("within_cosine")), different_speaker_cosine=told(".2f", s.get("between_cosine")), AUC=told(".2f", s.get("auc")), EER=told(".1%", s.get("eer")), flagged_speakers=told("d", s.get("flagged"))))
    if s := f.get("words"):
        lines.append(line("Transcripts", word_error_rate=told(".1%", s.get("mean")), clips=told("d", s.get("n"))))
    if s := f.get("emotion"):
        lines.append(line("Emotion tags", agreement=told(".0%", s.get("agreement")), kappa=told(".2f", s.get("kappa")), alpha=told(".2f", s.get("alpha"))))
    for language, s in sorted((f.get("phonemes") or {}).items()):
        lines.append(line(f"Phonemes, {language}", coverage=told(".0%", s)))
    if s := f.get("judge"):
        share = {k: (p := s.get(f"{k}_percent")) is not None and f"{p:.0f} %" or None for k in ("clean", "suitable", "supported")}
        lines.append(line("Larger model", clean_transcripts=share["clean"], suitable=share["suitable"], emotion_supported=share["supported"]))
    if s := f.get("audit"):
        lines += [line(f"Listening audit, {k}", yes=str(v)) for k, v in sorted(s.items())]
    return "\n".join(["", "## Evaluation", "", *lines, ""]) if lines else ""


def audit_rows(records: DataFrame, n: int = 40) -> DataFrame:
    """The sheet that listeners fill in: n clips a language at even distances in the order of their path, with empty answers."""
    from quernstone.functions import text as T
    from quernstone.operators.sequence import stride_a

    asked = ("transcript_correct", "emotion_correct", "audio_ok", "notes")
    return stride_a(records, ["language"], n, [F.col("audio")]).select(T.file_stem(F.col("audio")).alias("id"), "language", "emotion", F.col("text").alias("transcript"), *[F.lit("").alias(c) for c in asked], "audio")


def audit_page(rows: DataFrame, title: str = "Audit") -> str:
    """A static page that plays each clip of audit_rows(), takes yes or no for each question, and exports the sheet."""
    data = json.dumps([json.loads(r) for r in rows.toJSON().toLocalIterator()], ensure_ascii=False).replace("</", "<\\/")
    return (
        f'<!doctype html><meta charset="utf-8"><title>{title}</title><button onclick="save()">Export</button><div id="d"></div><script>const rows={data},asked=["transcript_correct","emotion_correct","audio_ok"];'
        "const esc=x=>String(x??'').replace(/[&<>\"]/g,c=>({'&':'&amp;','<':'&lt;','>':'&gt;','\"':'&quot;'}[c]));"
        "document.getElementById('d').innerHTML=rows.map((r,i)=>`<p><b>${esc(r.id)}</b> ${esc(r.language)} ${esc(r.emotion)}<br>${esc(r.transcript)}<br><audio controls src=\"${esc(r.audio)}\"></audio>`+asked.map(q=>`<label>${q}<select onchange=\"rows[${i}].${q}=this.value\"><option><option>y<option>n</select></label>`).join('')+'</p>').join('');"
        "function save(){const names=['id','language','emotion','transcript',...asked,'notes'],q=x=>'\"'+String(x??'').replace(/\"/g,'\"\"')+'\"';"
        "const a=document.createElement('a');a.href=URL.createObjectURL(new Blob([[names,...rows.map(r=>names.map(n=>r[n]))].map(l=>l.map(q).join(',')).join('\\n')],{type:'text/csv'}));a.download='audit.csv';a.click()}</script>"
    )
