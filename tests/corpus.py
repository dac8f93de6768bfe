"""A small corpus with the cases every source has to cope with, and a plain model of the rules."""

from __future__ import annotations

import csv
import json
import re
import unicodedata
from datetime import date
from functools import cache
from types import SimpleNamespace

from clearfold.schema import CANONICAL

# (ticket_id, source_uri, subject, updated_at, priority, status, body)
TICKETS = [
    ("T-1", "desk/t", "Login", "2026-02-10", "P2", "open", "Cannot sign in after a reset."),
    ("T-2", "desk/t", "Refund", "2026-02-09", "P3", "open", "Asks for money back, bought last week."),
    ("T-3", "desk/t", "Tunnel", "2026-02-09", "P2", "done", "Client reinstalled, connects again."),
    ("T-4", "desk/t", "Payment", "2026-02-10", "P1", "open", "Gateway answers 500 to many."),
    ("T-5", "desk/t", "Mail", "2026-02-08", "P3", "done", "Recovered with a one-time code."),
    ("T-6", "desk/t", "Access", "2026-02-08", "P2", "open", "Waits for a lead's consent."),
    ("T-7", "desk/t", "Printer", "2026-02-07", "P4", "done", "Driver restarted."),
    ("T-8", "desk/t", "Sync", "2026-02-07", "P2", "open", "Night job failed."),
    ("T-9", "desk/t", "Locked", "2026-02-06", "P3", "done", "Identity confirmed, opened."),
    ("T-10", "desk/t", "Quota", "2026-02-06", "P3", "open", "Needs more space."),
    ("T-11", "desk/t", "Spam", "2026-02-05", "P4", "done", "Rule added."),
    ("T-12", "desk/t", "File", "2026-02-05", "P3", "done", "Broken file, sent anew."),
    ("T-13", "desk/t", "Network", "2026-02-04", "P1", "done", "Switch replaced."),
    ("T-14", "desk/t", "Install", "2026-02-04", "P3", "open", "Waits for a licence."),
    ("T-15", "desk/t", "Contact", "2026-02-03", "P4", "done", "Number changed."),
    ("T-3", "desk/t", "Tunnel", "07/02/26", "P2", "done", "Client reinstalled, connects again."),
    ("T-16", "desk/t", "Question", "2026-02-10", "P2", "open", "How fast is a P1 answered?"),
    ("T-17", "desk/t", "Token", "", "P3", "open", "Lost device, wants a new token."),
]
# (key, summary, updated, priority, status, description)
ISSUES = [
    (f"OPS-{n}", f"Issue {n}", f"2026-02-{10 - n:02d}", "P3", "open", f"Work item número {n}.")
    for n in range(1, 7)
]
# (doc_id, source_uri, title, effective_date, version, ocr_confidence, content)
DOCUMENTS = [
    ("12", "p/refund3.pdf", "Refunds", "2026-01-15", "v3", "0.98", "Refunds: money back within 14 days."),
    ("12", "p/refund4.pdf", "Refunds", "2026-02-07", "v4", "0.98", "Refunds: money back within 7 days."),
    ("12", "p/refund4.pdf", "Refunds", "07/02/26", "v4", "0.98", "  Refunds: money  back within 7 days.  "),
    ("44", "p/access.md", "Access", "2026-02-08", "v2", "0.95", "Access: a manager must approve, then it is granted."),
    ("58", "p/p1.pdf", "P1", "2026/02/10", "v1", "0.96", "P1 incidents are answered within 2 hours."),
    ("67", "k/recover.html", "Recovery", "2026-02-11", "v1", "0.93", "Recover an account by mail, verified twice."),
    ("71", "k/vpn.html", "Tunnel", "2026-02-05", "v2", "0.90", "Tunnel: install, sign in, choose a région."),
    ("80", "p/password.pdf", "Passwords", "2026-02-03", "v1", "0.97", "Twelve characters, changed every 90 days."),
    ("81", "k/empty.html", "", "2026-02-06", "", "0.40", "     "),
    ("90", "p/keep.pdf", "Retention", "2026-01-20", "v1", "0.95", "Logs are kept 180 days."),
    ("91", "p/join.md", "Joining", "", "v1", "0.95", "New staff get accounts, devices, training."),
]
# A day that does not exist but has the right shape, and a noisy scan.
FAULTY_DOCUMENTS = [
    ("95", "p/holiday.pdf", "Holidays", "2026-13-45", "v1", "0.97", "Days off as agreed."),
    ("96", "p/scan.pdf", "Scan", "2026-02-09", "v1", "0.42", "Sc�n of a pr�cess."),
]
QUESTIONS = [
    ("q1", "Refunds: money back within how many days?", ["7", "days"], "14"),
    ("q2", "Within how many hours are P1 incidents answered?", ["2", "HOURS"], None),
    ("q3", "Who must approve access?", ["manager", "approve"], None),
]
QUESTION_SCHEMA = (
    "question_id string, question string, expect_keywords array<string>, stale_marker string"
)


def write_sources(folder, documents=DOCUMENTS, tickets=TICKETS, issues=ISSUES):
    folder.mkdir(parents=True, exist_ok=True)
    heads = {
        "tickets.csv": ("ticket_id source_uri subject updated_at priority status body", tickets),
        "documents.csv": ("doc_id source_uri title effective_date version ocr_confidence content", documents),
    }
    for name, (head, rows) in heads.items():
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(head.split())
            w.writerows(rows)
    keys = "key summary updated priority status description".split()
    objects = [dict(zip(keys, i)) for i in issues]
    (folder / "issues.json").write_text(json.dumps(objects, ensure_ascii=False, indent=1), "utf-8")
    lines = "\n".join(json.dumps(o, ensure_ascii=False) for o in objects)
    (folder / "issues.jsonl").write_text(lines + "\n", "utf-8")
    return folder


def records(spark, rows):
    """Rows (ingest_seq, doc_id, source_type, date, version, ocr, content) as a DataFrame."""
    full = [
        (seq, doc, source, f"{source}/{seq}", f"title {seq}", date, version, ocr, content)
        for seq, doc, source, date, version, ocr, content in rows
    ]
    return spark.createDataFrame(full, CANONICAL)


SHAPES = {
    r"(?P<y>[0-9]{4})-(?P<m>[0-9]{1,2})-(?P<d>[0-9]{1,2})": 0,
    r"(?P<y>[0-9]{4})/(?P<m>[0-9]{1,2})/(?P<d>[0-9]{1,2})": 0,
    r"(?P<d>[0-9]{1,2})/(?P<m>[0-9]{1,2})/(?P<y>[0-9]{4})": 0,
    r"(?P<d>[0-9]{1,2})/(?P<m>[0-9]{1,2})/(?P<y>[0-9]{2})": 2000,
}


def iso_date(value):
    """ISO text of a day in any accepted shape, None for anything else."""
    for shape, century in SHAPES.items():
        m = re.fullmatch(shape, (value or "").strip())
        if m:
            year = int(m["y"]) + century - (100 if century and int(m["y"]) >= 69 else 0)
            try:
                return date(year, int(m["m"]), int(m["d"])).isoformat()
            except ValueError:
                return None
    return None


def model(rows):
    """Outcome per ingest_seq, by comparing every record with every other one."""
    facts = []
    for seq, doc, source, raw, version, ocr, content in rows:
        words = unicodedata.normalize("NFC", content or "").split()
        facts.append(
            SimpleNamespace(
                seq=seq, doc=doc, text=" ".join(words), copy_of=(doc, source, " ".join(words)),
                day=iso_date(raw), undated=not (raw or "").strip(), version=version,
                doubtful=ocr < 0.60 or "\ufffd" in (content or ""),
            )
        )

    earliest = {}
    for a in facts:
        earliest[a.copy_of] = min(a.seq, earliest.get(a.copy_of, a.seq))

    def beats(b, a):
        """Dated before undated, later before earlier day, then input order."""
        return (b.day is not None, b.day or "", -b.seq) > (a.day is not None, a.day or "", -a.seq)

    @cache
    def champion(doc):
        rivals = [b for b in facts if b.doc == doc and b.text and b.seq == earliest[b.copy_of]]
        return next(b for b in rivals if not any(beats(c, b) for c in rivals))

    def outcome(a):
        if not a.text:
            return "reject", "empty_content"
        if a.seq > earliest[a.copy_of]:
            return "reject", "duplicate_content_hash"
        best = champion(a.doc)
        if best is not a:
            return "reject", f"superseded_by_{best.version or best.day}" if best.day else "superseded_no_date"
        if a.undated:
            return "flag", "review_missing_date"
        return ("flag", "review_low_ocr") if a.doubtful else (None, None)

    return {a.seq: outcome(a) for a in facts}
