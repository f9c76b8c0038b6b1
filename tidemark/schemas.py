"""Schemas of the files and tables the library reads."""

from __future__ import annotations

RESULT_TEXT = "commit string, val_text string, mem_text string, status_text string, description string"

FROM_VALUE_RECORD = "conversations array<struct<from: string, value: string>>"

#: Content may be a string or a list of parts.
RECORD = "conversations array<struct<from: string, value: string, role: string, content: variant>>"

METRICS = """mode string, run_tag string, started_at string, finished_at string, output_dir string,
    stages map<string, double>, env struct<cuda_visible_devices: string, hostname: string>,
    torch_version string, cuda_available boolean, gpu_name string, model string,
    lora struct<r: int, alpha: int, dropout: double>,
    dataset struct<source: string, split: string, raw_size: bigint, size: bigint, filtered_out: bigint>,
    training_config struct<max_steps: int, num_train_epochs: int, learning_rate: double, batch_size: int,
      grad_accum: int, scheduler: string, warmup_steps: int>,
    training_result struct<train_runtime_sec: double, train_samples_per_second: double,
      train_steps_per_second: double, train_loss: double, total_flos: double>,
    peak_vram_gb double, inference_baseline array<struct<prompt: string, response: string>>,
    inference_posttraining array<struct<prompt: string, response: string>>,
    final_output_path string, total_wall_sec double"""

GPU_SNAPSHOT = "name string, memory_used double, memory_total double, utilization double, temperature double"

JOB_STATE = "slug string, at_us bigint, event_id bigint, state string"

PACKED = "packer_id bigint, row_id bigint, tokens array<int>, epoch int, drain boolean, docs int, cropped bigint"
