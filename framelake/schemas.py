"""Schemas of the persistent tables and feeds."""

SAMPLES = "id string, camera string, ts double, event_id string, frame_index int, image_path string, image_hash string, status string, quality string, verified int, feed_label string, created_at string"
ANNOTATIONS = "id string, sample_id string, event_id string, source string, label string, x1 double, y1 double, x2 double, y2 double, confidence double, verified int, created_at string"
FAILURES = "event_id string, camera string, error string, created_at string"
WINDOWS = "camera string, start double, end double, peak_motion double, buckets long, notes string"
DEPLOYMENTS = "id string, model_name string, version string, metrics_json string, verdict string, reasons_json string, created_at string"
OVERRIDES = "object_id string, status string, updated_at string"
REVIEW_FEED = "id string, camera string, severity string, thumb_path string, start_time string, end_time string, data variant, zones array<string>, _corrupt_record string"
EVENT_FEED = "id string, camera string, label string, start_time string, end_time string, top_score string, score string, false_positive boolean, zones array<string>, has_clip boolean, has_snapshot boolean, sub_label string, plus_id string, box array<double>, data string, _corrupt_record string"
MOTION_FEED = "start_time string, motion string, camera string, _corrupt_record string"
COCO = "images array<struct<id:long,file_name:string,width:int,height:int>>, annotations array<struct<id:long,image_id:long,category_id:long,bbox:array<double>,score:double>>, categories array<struct<id:long,name:string>>"
_CONVENTION = "image_root:string,bbox_format:string,normalized:boolean,coordinate_space:string,frame_size:array<double>"
AUDIT_MANIFEST = (
    "image_root string, bbox_format string, normalized boolean, coordinate_space string, frame_size array<double>, class_map map<string,int>, "
    f"objects array<struct<id:string,image:string,class_name:string,bbox:array<double>,crop_origin:array<double>,width:double,height:double,{_CONVENTION}>>"
)
MANIFEST = "sample_id string, image string, camera string, timestamp double, split string, source string, verified int, labels array<string>, created_at string"
BENCHMARK = "results array<struct<name:string,version:string,kind:string,map50:double,map50_95:double,recall:double,precision:double,fp_rate:double,latency_ms:double,fps:double,cpu_percent:double>>"
