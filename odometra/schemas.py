"""Explicit schemas of the domain tables, as DDL; nothing is inferred."""

from __future__ import annotations

CAMERAS = "camera_id bigint, model string, width int, height int, params array<double>"
IMAGES = "image_id bigint, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id bigint, name string"
POINTS2D = "image_id bigint, point2d_idx int, x double, y double, point3d_id bigint"
POINTS3D = "point3d_id bigint, x double, y double, z double, r int, g int, b int, error double"
TRACKS = "point3d_id bigint, image_id bigint, point2d_idx int"
MESSAGES = "topic string, ts_ns bigint, msgtype string, payload binary"
TOPICS = "name string, msgtype string, msgcount int"
FRAMES = "frame_id int, ts_ns bigint, filename string"
ASSOCIATIONS = "frame_id int, rgb_ts bigint, depth_ts bigint, camera_info_ts bigint, delta bigint"
TRAJECTORY = "frame_id int, image_name string, R array<double>, t array<double>, qvec_w2c array<double>, tvec_w2c array<double>"
TIMESTAMPS_CSV = "timestamp_ns bigint, filename string"
PAIRS = "pair_id bigint, rows int, cols int, data binary"
TWO_VIEW = "pair_id bigint, rows int, cols int, data binary, config int"
MANIFEST = "version string, bag_path string, topics map<string,string>, settings map<string,string>, num_rgb_frames int, num_depth_frames int, start_ns bigint, end_ns bigint"
