from tabloom.streaming.scoring import open_stream, score_stream, write_stream
from tabloom.streaming.sink import read_scored, score_to_table

__all__ = ["open_stream", "read_scored", "score_stream", "score_to_table", "write_stream"]
