"""Explicit schemas of the corpus relations; every reader takes one."""

from __future__ import annotations

CHUNK = "chunk_index int, chunk_file string, start_s double, end_s double, duration_s double, speech_segments array<struct<start:double,end:double>>"
CHUNK_MANIFEST = f"source_file string, file_duration_s double, total_chunks int, vad_params map<string,string>, chunks array<struct<{CHUNK.replace(' ', ':').replace(',:', ',')}>>"
HYPOTHESIS = "chunk_index int, chunk_file string, ctc_lm_hyp string"
OPTIONS = "chunk_index int, chunk_file string, start_s double, end_s double, hyp_options array<string>"
WORD = "struct<word:string,start:double,end:double,score:double,pass:int>"
ALIGNMENT = (
    "source_file string, chunk_index int, chunk_file string, chunk_start_s double, chunk_end_s double, asr_hypothesis string, "
    "ref_match struct<word_start_idx:int,word_end_idx:int,matched_text:string,norm_edit_dist:double>, "
    f"words array<{WORD}>, resync struct<resynced:boolean,old_start_idx:int,old_norm_edit_dist:double,vote_score:double>"
)
TIMELINE = "word string, start_abs double, end_abs double, score double, ref_word_idx int, chunk_index int"
SEGMENT_ROW = "audio_filepath string, duration double, text string, file string, unit string, speaker string, seg_index bigint, avg_score double, min_score double"
PADDED_ROW = SEGMENT_ROW + ", orig_audio_filepath string, pad_s double"
EVAL_ROW = SEGMENT_ROW + ", hyp string, ref_norm string, hyp_norm string, ref_words int, wer double"
ASSIGNMENT = "speaker string, split string, duration_s double, segments int"
