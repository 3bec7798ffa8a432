from pixsieve.streaming.arrivals import ArrivingImages, image_stream
from pixsieve.streaming.online import annotate_requests, parse_requests, quality_stream, run_to_end

__all__ = ["ArrivingImages", "annotate_requests", "image_stream", "parse_requests", "quality_stream", "run_to_end"]
