"""Identifiers and times of clips: `<source>_<start>_<end>` ids, order keys, shards, frame numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.rounding import half_even, half_even_int

#: Frames and frames a second of a window, and the tolerance at its edges.
WINDOW_FRAMES, FPS, EPS = 81, 16, 1e-9
WINDOW_SEC = WINDOW_FRAMES / FPS
DEFAULT_SEED = 20260725

_CLIP = r"(?s)^(.*)_([^_]*)_([^_]*)$"


def clip_source(clip: Column) -> Column:
    """The part before the last two underscores; an id without them raises when its times are read."""
    return F.regexp_extract(clip, _CLIP, 1)


def clip_start(clip: Column) -> Column:
    return F.regexp_extract(clip, _CLIP, 2).cast("double")


def clip_end(clip: Column) -> Column:
    return F.regexp_extract(clip, _CLIP, 3).cast("double")


def source_of(clip: Column) -> Column:
    """Like clip_source, but an id with fewer underscores loses only what it has."""
    return F.regexp_replace(clip, r"(?s)(_[^_]*){1,2}$", "")


def url_video_id(url: Column) -> Column:
    """What follows the first v= of a url, up to the next &; null if there is none."""
    return F.nullif(F.regexp_extract(url, r"v=([^&]+)", 1), F.lit(""))


def object_key(video: Column, ext: Column, root: str) -> Column:
    """root/video/video.ext, null where either is unknown."""
    return F.concat(F.lit(root + "/"), video, F.lit("/"), video, ext)


def frame_time(start: Column, end: Column, position: Column) -> Column:
    """Seconds of a position between 0 (start) and 1 (end); the position may be text."""
    return start + position.cast("double") * (end - start)


def sample_id(source: Column, window_start: Column) -> Column:
    """source_wNNNNNNNNN with the start in milliseconds; nine digits at least, never cut."""
    return F.format_string("%s_w%09d", source, half_even(window_start * 1000.0).cast("long"))


def order_key(text: Column, seed: int = DEFAULT_SEED) -> Column:
    """A seeded order that does not depend on other rows."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), text), 256)


def shard_of(source: Column, shards: int) -> Column:
    """The shard of a source: the first 64 bits of its own hash, so it never moves when others come or seeds change."""
    if shards <= 1:
        return F.lit(0)
    head = F.conv(F.substring(F.sha2(F.concat(F.lit("shard:"), source), 256), 1, 16), 16, 10)
    return (head.cast("decimal(20,0)") % F.lit(shards).cast("decimal(20,0)")).cast("int")


def seed_index(seed: Column, window_start: Column, fps: int = FPS, frames: int = WINDOW_FRAMES) -> Column:
    """Frame of a time inside its window, kept between the first and the last one."""
    return F.least(F.greatest(half_even_int((seed - window_start) * F.lit(float(fps))), F.lit(0)), F.lit(frames - 1))


def frame_indices(window_start: Column, source_fps: Column, total: Column, frames: int = WINDOW_FRAMES, fps: int = FPS) -> Column:
    """Source frames of a window's frames; capped at the last one, not at the first."""
    return F.transform(F.sequence(F.lit(0), F.lit(frames - 1)), lambda i: F.least(half_even_int((window_start + i / F.lit(float(fps))) * source_fps), total - 1))


def nearest_frame(time: Column, fps: Column, total: Column) -> Column:
    """Frame nearest to a time; capped at the last one, not at the first."""
    return F.least(half_even_int(time * fps), total - 1)
