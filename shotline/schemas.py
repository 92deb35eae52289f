"""Schemas of the entities, as DDL.  Nothing is ever inferred from data."""

from __future__ import annotations

SHOTS_RAW = "video_id string, shot_id string, start_frame bigint, end_frame bigint, fps double"
SEGMENTS = "video_id string, seg_id string, start_ms bigint, end_ms bigint, text string"
SHOT_TRANSCRIPTS = "video_id string, shot_id string, text string"
KEYFRAMES = "video_id string, shot_id string, keyframe_id string, frame_idx bigint, timestamp_ms bigint, image_path string"
MAP_KEYFRAMES = "n int, pts_time double, fps double, frame_idx bigint"
OCR = "frame_id string, texts array<struct<text:string,confidence:double,box:array<int>>>"
DETECTIONS = "frame_id string, objects array<struct<label:string,confidence:double,bbox:array<double>>>"
EMBEDDINGS = "model string, frame_id string, video_id string, frame_idx bigint, shot_id string, timestamp_ms bigint, embedding array<float>"
RECAP = "video_id string, keyframe_id string, caption string, corrected_ocr array<string>"
FAILURES = "video_id string, keyframe_id string, error string"
SHOTS = "video_id string, shot_id string, start_frame bigint, end_frame bigint, fps double, start_ms bigint, end_ms bigint, transcript string"
FRAMES = (
    "keyframe_id string, video_id string, shot_id string, frame_idx bigint, timestamp_ms bigint, image_path string, batch string, objects map<string,double>, "
    "ocr_text string, ocr_api string, caption string, embeddings struct<beit3:boolean,siglip:boolean,siglip2:boolean,clip32:boolean>, synced struct<elastic:boolean,milvus:boolean>"
)
STATUS = "video_id string, steps map<string,struct<status:string,updated_at:string,count:bigint>>"
INDEX_DOC = "frame_id string, video_id string, shot_id string, frame_idx bigint, timestamp_ms bigint, ocr_text string, ocr_api string, caption string, transcript string, object_tags array<string>"
HIT = "keyframe_id string, video_id string, shot_id string, frame_idx bigint, timestamp_ms bigint, score double"
#: Vector length of each model.
DIMS = {"beit3": 1024, "siglip": 1152, "siglip2": 1152, "clip32": 512}
