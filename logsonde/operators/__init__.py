"""The analyses: each public function takes and returns DataFrames."""
