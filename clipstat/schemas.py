"""Input schemas. Counters stay text until they are normalised; ids are strings."""

from __future__ import annotations

_URLS = "struct<url_list: array<string>>"

POSTS_RAW = f"""
aweme_id string, aweme_type string, desc string, title string, nickname string, author_word string,
create_time string, liked_count string, comment_count string, collected_count string, share_count string,
video_download_url string, cover_url string, music_download_url string, music_url string,
note_download_url string, sec_uid string, run_id string,
statistics struct<digg_count: string, collect_count: string, comment_count: string, share_count: string>,
video struct<play_addr: {_URLS}, play_addr_h264: {_URLS}, play_addr_256: {_URLS}, raw_cover: {_URLS}, origin_cover: {_URLS}>,
images array<struct<origin_url: {_URLS}>>
"""

COMMENTS_RAW = """
aweme_id string, comment_id string, content string, nickname string, like_count string, create_time bigint
"""

CREATOR_COUNTS = "aweme_count bigint, follower_count bigint, total_favorited bigint, sec_uid string"

TRANSCRIPTS = """
aweme_id string, cache_version string, cache_schema string, config_hash string, audio_sha256 string,
requested_device string, requested_compute string, actual_device string, actual_compute string, runner string,
language string, language_probability double, duration double, avg_logprob double, decode_beam int,
needs_visual_review boolean, source_kind string, source_url_hash string, fallback_reason string,
audio_path string, text string,
segments array<struct<start: double, end: double, text: string, confidence: double, probability: double,
language_probability: double, avg_logprob: double>>
"""

SOUNDTRACK = """
aweme_id string, cache_version string, config_hash string, source_kind string, analysis_scope string,
analysis_status string, source_status string, bgm_level string, mood string, vocal string, energy double,
energy_var double, silence double, lfe_ratio double, duration_seconds double, non_speech_seconds double,
non_speech_coverage double,
non_speech_windows array<struct<start: double, end: double, duration: double>>, limitations array<string>,
audio_sha256 string
"""

FRAMES = """
completed boolean, source_type string, backend string, scan_backend string, render_backend string,
fallback_reason string,
frames array<struct<file: string, timestamp: double, reason: string, scene_score: double, brightness: double,
sharpness: double>>
"""

_SUMMARY = {
    "aweme_id": "string",
    "frames_analyzed": "int",
    "visual_style": "string",
    "color": "struct<temperature: string, mean_hsv: array<double>>",
    "composition": "struct<dominant: string>",
    "scene": "struct<dominant_candidate: string, status: string>",
    "subtitles": "struct<frame_ratio: double, dominant_region: string>",
    "product_exposure": "struct<candidate_frame_ratio: double, candidate_timestamps: array<double>, status: string>",
    "ocr_status": "string",
}
_SUMMARY_STRUCT = f"struct<{', '.join(f'{n}: {t}' for n, t in _SUMMARY.items())}>"

# Summaries come wrapped in ``videos`` or ``records``, or as a bare list with the fields on top.
VISUAL = f"videos array<{_SUMMARY_STRUCT}>, records array<{_SUMMARY_STRUCT}>, " + ", ".join(
    f"{n} {t}" for n, t in _SUMMARY.items()
)
