"""Collector state: rules shared by batch replay and by streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRACE_S = 90
STEPS = (1, 3, 5)
LEASE_S = 30 * 60
SKIP_RATE, UNKNOWN_TARGET_LEAST = 0.9, 50
# The collector's reasons and sources.
RELIABLE_SOURCES = ("view_all_comments_button", "view_all_comments_text")
HARD_LIMITATIONS = ("login_wall", "challenge_required", "rate_limited_try_again_later", "rate_limited_activity_restricted", "rate_limited_wait")
HARD_FAILURES = ("tab_create_failed", "content_script_error", "post_unavailable", "login_wall", "challenge_required")
EXHAUSTED = ("comments_exhausted_bottom_reached", "comments_exhausted_no_new_rounds")
BACKOFF = (*HARD_LIMITATIONS, "tab_load_timeout", "post_hydrate_timeout", "post_detail_timeout", "post_detail_step_timeout", "no_response")
INTERRUPTED = "worker_interrupted_resume_available"


def session_id(c: Column) -> Column:
    """A session's identity: trimmed; blank ones are none."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def session_key(run: Column, worker: Column, post: Column) -> Column:
    return F.concat_ws(":", run, worker, post)


def fenced(messages: DataFrame, active: DataFrame, worker: str, session: str, running: str | None = None) -> DataFrame:
    """Messages with a column `accepted`: without any session, or from the active session of a worker whose run is running.

    active: (worker, active[, running boolean]); blank sessions are none.
    """
    j = messages.join(active, worker, "left")
    same = session_id(F.col(session)) == session_id(F.col("active"))
    if running is not None:
        same = same & F.coalesce(F.col(running), F.lit(False))
    return j.withColumn("accepted", F.coalesce(session_id(F.col(session)).isNull() | same, F.lit(False)))


def recovery_state(running: Column, age_s: Column, active_run: Column | None = None) -> Column:
    """A run by the age of its last heartbeat; exactly the grace still counts as recent. Without any time it is stale."""
    state = F.when(~F.coalesce(running, F.lit(False)), "not_running")
    if active_run is not None:
        state = state.when(active_run, "active_run")
    return state.when(age_s <= GRACE_S, "recent").otherwise("stale")


def heartbeat(heartbeat_at: Column, updated_at: Column) -> Column:
    """The time a run was last heard of."""
    return F.coalesce(heartbeat_at, updated_at)


def interrupted(checkpoints: DataFrame, which: Column, at: Column) -> DataFrame:
    """Checkpoints with the five fields of an interruption set where `which` holds."""
    marks = {"status": F.lit("stopped"), "stop_reason": F.lit(INTERRUPTED), "interrupted_at": at, "recovery_state": F.lit("interrupted_resume_available"), "active_workers": F.lit(0)}
    kinds = dict(checkpoints.dtypes)
    return checkpoints.withColumns({k: F.when(which, v.cast(kinds[k]) if k in kinds else v).otherwise(F.col(k) if k in kinds else F.lit(None)) for k, v in marks.items()})


def freshness(age_s: Column) -> Column:
    return F.when(age_s < 5, "live").when(age_s < 30, "fresh").when(age_s < 120, "quiet").otherwise("silent")


def meaningful(captured: Column, active: Column, status: Column, reason: Column) -> Column:
    """Whether an attempt brought anything or failed for another reason than that its page never loaded."""
    return (F.coalesce(captured, F.lit(0)) > 0) | active | ((status == "failed") & ~F.coalesce(reason == "tab_load_timeout", F.lit(False)))


def claimable(status: Column, attempts: Column, retry_partial: Column, retry_failed: Column) -> Column:
    """Queued posts; partial ones of fewer than two attempts and failed ones where a retry is allowed."""
    return (status == "queued") | (retry_partial & status.isin("partial", "partial_unknown_target") & (F.coalesce(attempts, F.lit(0)) < 2)) | ((status == "failed") & retry_failed)


def reliable_target(count: Column, source: Column) -> Column:
    """A target that may be trusted: above 0 and from a reliable source; else null."""
    return F.when((count > 0) & source.isin(*RELIABLE_SOURCES), count)


def covered(captured: Column, target: Column, source: Column, skip_unknown: bool = False) -> Column:
    """Posts that need no collecting: nine tenths of a reliable target, or fifty comments where there is none and that is allowed."""
    enough = F.coalesce(captured / reliable_target(target, source) >= SKIP_RATE, F.lit(False))
    none = ~F.coalesce(target > 0, F.lit(False))
    return enough | (none & (captured >= UNKNOWN_TARGET_LEAST)) if skip_unknown else enough


def final_status(captured: Column, target: Column, reason: Column) -> Column:
    """A post's status when its collection ends."""
    has = F.coalesce(target > 0, F.lit(False))
    hard = reason.isNull() | (reason == "") | reason.isin(*HARD_FAILURES)
    done = (has & (captured >= target)) | (~has & reason.isin(*EXHAUSTED) & (captured >= UNKNOWN_TARGET_LEAST))
    return F.when(F.coalesce(done, F.lit(False)), "complete").when(~has & (captured > 0) & ~hard, "partial_unknown_target").when((captured > 0) & ~hard, "partial").otherwise("failed")


def released(status: Column, captured: Column, lease_age_s: Column, force: bool = False) -> Column:
    """A post's status after leases older than half an hour, or all, have ended."""
    ends = F.lit(True) if force else (lease_age_s >= LEASE_S) | lease_age_s.isNull()
    return F.when((status == "in_progress") & ends, F.when(captured > 0, "partial").otherwise("queued")).otherwise(status)


def requeued(status: Column, captured: Column, active: Column, reason: Column) -> Column:
    """Whether a failed post goes back to the queue: nothing was captured or begun, as its page never loaded."""
    return (status == "failed") & ~(F.coalesce(captured, F.lit(0)) > 0) & ~active & F.coalesce(reason == "tab_load_timeout", F.lit(False))


def backoff(reason: Column) -> Column:
    """Whether an outcome speaks for fewer workers."""
    return F.coalesce(reason.isin(*BACKOFF) | reason.startswith("navigation_error:"), F.lit(False))


def next_concurrency(allowed: int, stable: int, n: int, limited: int) -> tuple[int, int]:
    """(allowed, stable) after a batch: one step down when limited, one up after three calm batches."""
    i = STEPS.index(allowed)
    if n and (limited >= 3 or limited / n >= 0.25):
        return STEPS[max(0, i - 1)], 0
    stable += 1
    return (STEPS[min(len(STEPS) - 1, i + 1)], 0) if stable >= 3 and i + 1 < len(STEPS) else (allowed, stable)


def replay_concurrency(hours: pd.DataFrame) -> pd.DataFrame:
    allowed, stable, out = STEPS[-1], 0, []
    for r in hours.sort_values("hour").itertuples():
        allowed, stable = next_concurrency(allowed, stable, r.n, r.limited)
        out.append((r.session, r.hour, r.limited, allowed))
    return pd.DataFrame(out, columns=["session", "hour", "limited", "allowed"])


class Discovery:
    """Whether profile discovery goes on after a round of (added, scroll_top, limitation)."""

    def __init__(self, no_new: int = 30, stuck: int = 8, max_rounds: int = 1500, max_posts: int | None = None):
        self.no_new, self.stuck, self.max_rounds, self.max_posts = no_new, stuck, max_rounds, max_posts
        self.rounds = self.idle = self.same = self.total = 0
        self.top, self.reason = -1.0, None

    def round(self, added: int, scroll_top: float, limitation: str | None = None) -> str | None:
        """The reason to stop, or None."""
        if limitation:
            self.reason = f"profile_discovery_{limitation}" if limitation in HARD_LIMITATIONS else limitation
            return self.reason
        self.rounds += 1
        self.total += added
        self.idle = 0 if added else self.idle + 1
        self.same = self.same + 1 if scroll_top <= self.top + 2 and not added else 0
        self.top = scroll_top
        if self.max_posts and self.total >= self.max_posts:
            self.reason = f"max_posts_discovery_limit_{self.max_posts}"
        elif self.idle >= self.no_new:
            self.reason = f"no_new_posts_after_{self.no_new}_rounds"
        elif self.same >= self.stuck:
            self.reason = "profile_scroll_stuck"
        elif self.rounds >= self.max_rounds:
            self.reason = f"profile_max_rounds_reached_{self.max_rounds}"
        return self.reason


class Capture:
    """Whether a post's capture goes on after a snapshot; the first of the rules that holds decides."""

    def __init__(self, target: int | None = None, coverage: bool = False, most: int = 250, rate: float = 0.5, coverage_s: float = 240, no_new: int = 8, max_s: float = 480):
        self.target, self.coverage, self.most, self.rate, self.coverage_s, self.no_new, self.max_s = target, coverage, most, rate, coverage_s, no_new, max_s
        self.idle = 0

    def snapshot(self, captured: int, progress: bool, moved: bool, near_bottom: bool, age_s: float, limitation: str | None = None, visible: bool = True) -> str | None:
        """The reason to stop, or None."""
        if limitation:
            return limitation
        if not visible:
            return "visibility_lost"
        if self.target and captured >= self.target:
            return "target_reached"
        if self.coverage:
            if captured >= self.most:
                return "coverage_max_comments_reached"
            if self.target and captured / self.target >= self.rate:
                return "coverage_min_rate_reached"
            if age_s >= min(self.max_s, self.coverage_s):
                return "coverage_max_runtime_reached"
        self.idle = 0 if progress else self.idle + 1
        if self.idle >= self.no_new and near_bottom and not moved:
            return "comments_exhausted_bottom_reached"
        if self.idle >= 3 * self.no_new and not moved and not near_bottom:
            return "partial_scroll_stalled_before_bottom"
        return "max_post_runtime_reached" if age_s >= self.max_s else None


def sampled(round_no: Column, new: Column, reason: Column) -> Column:
    """Which snapshots are kept: the first six, those with news, every fifth, and the last."""
    return (round_no <= 5) | (new > 0) | (round_no % 5 == 0) | reason.isNotNull()


def compacted(records: DataFrame, comments: str, total: str, keep: int = 5) -> DataFrame:
    """Raw records with the first `keep` comments, how many were cut, and how many there were."""
    n = F.coalesce(F.size(comments), F.lit(0))
    return records.withColumns({comments: F.slice(comments, 1, keep), f"{comments}_truncated": F.greatest(n - keep, F.lit(0)), f"{comments}_total": F.coalesce(F.col(total).cast("bigint"), n.cast("bigint"))})


OPTION_LIMITS = {"preload_tabs": (1, 5, 5), "coverage_min_rate": (0.0, 1.0, 0.5), "max_post_s": (30, None, 480), "post_step_s": (5, 25, 18), "no_new_comment_rounds": (1, None, 8), "profile_no_new_rounds": (5, None, 30), "coverage_max_comments": (1, None, 250), "coverage_max_minutes": (1, None, 4)}


def normalize_options(raw: dict) -> dict:
    """Options within their limits; missing, unreadable and zero values are the defaults."""
    out = dict(raw)
    for k, (low, high, default) in OPTION_LIMITS.items():
        try:
            x = float(raw.get(k) or default)
        except (TypeError, ValueError):
            x = float(default)
        x = max(low, x) if high is None else max(low, min(high, x))
        out[k] = round(x) if k == "preload_tabs" else x
    out["mode"] = raw.get("mode") if raw.get("mode") in ("full", "discover_only", "scrape_queue", "resume") else "full"
    out["scrape_mode"] = "coverage" if raw.get("scrape_mode") == "coverage" else "exhaustive"
    out["max_posts"] = int(raw["max_posts"]) if str(raw.get("max_posts", "")).isdigit() and int(raw["max_posts"]) > 0 else None
    out["skip_covered"] = raw.get("skip_covered") is not False
    out["skip_unknown_target"] = raw.get("skip_unknown_target") is True
    return out


CHECKPOINT = {"version": 3, "status": "idle", "stop_reason": None, "heartbeat_at": None, "updated_at": None, "active_run_session_id": None, "active_workers": 0, "discovered_post_queue": [], "counts": {}, "concurrency": {"configured": 5, "effective": 5, "stable_batches": 0, "last_backoff_at": None}, "discovery": {"rounds": 0, "no_new_rounds": 0, "scroll_stuck_rounds": 0, "stop_reason": None}}


def normalize_checkpoint(old: dict | None) -> dict:
    """A checkpoint of any age in the present form: what it lacks is filled in, its version is 3 at least."""
    out = {k: ({**v, **(old or {}).get(k, {})} if isinstance(v, dict) and isinstance((old or {}).get(k, {}), dict) else (old or {}).get(k, v)) for k, v in CHECKPOINT.items()}
    out |= {k: v for k, v in (old or {}).items() if k not in out}
    out["version"] = max(int((old or {}).get("version") or 0), 3)
    return out


def stripped_for_recovery(checkpoint: dict) -> dict:
    """A checkpoint without its posts, saying so."""
    return {k: v for k, v in checkpoint.items() if k != "posts"} | {"posts_omitted": "posts" in checkpoint}


def normalize_queue(posts: DataFrame, code: Column, kind: Column, attempts: str = "attempts") -> DataFrame:
    """Queued posts from imported ones: those without a valid shortcode are left out, running ones wait again, the target falls back to the displayed count."""
    q = posts.withColumns({"shortcode": F.trim(F.coalesce(F.nullif(F.trim("shortcode"), F.lit("")), code)), "post_kind": F.coalesce(F.nullif(F.trim("post_kind"), F.lit("")), kind, F.lit("post"))})
    q = q.where(F.col("shortcode").rlike("^[A-Za-z0-9_-]+$"))
    status = F.when(F.coalesce("status", F.lit("in_progress")) == "in_progress", "queued").otherwise(F.col("status"))
    return q.withColumns({"status": status, attempts: F.coalesce(F.col(attempts), F.lit(0)), "target_comment_count": F.coalesce("target_comment_count", "displayed_comment_count"), "position": F.coalesce("visible_index", "position")})


def normalize_comments(comments: DataFrame) -> DataFrame:
    """Imported comments with both keys, without what is not stored."""
    return comments.drop("extraction_quality", "post_caption").where("nullif(comment_id, '') IS NOT NULL AND nullif(post_shortcode, '') IS NOT NULL")


def add_discovered(known: DataFrame, found: DataFrame, key: str = "shortcode") -> DataFrame:
    """The found posts that are not known, each once: those newly queued."""
    return found.dropDuplicates([key]).join(known.select(key), key, "left_anti").withColumn("status", F.lit("queued"))


def hydrated(posts: DataFrame, details: DataFrame, key: str = "shortcode") -> DataFrame:
    """Posts with what a hydration read, field by field where it read anything; a target only from a reliable source."""
    d = details.withColumn("target_comment_count", reliable_target(F.col("target_comment_count"), F.col("target_comment_source")))
    both = posts.alias("a").join(d.alias("b"), key, "left")
    return both.select(*[F.col(key) if c == key else (F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")) if c in d.columns else F.col(f"a.{c}")).alias(c) for c in posts.columns])
