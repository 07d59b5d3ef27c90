"""Review sentiment, game scoring, property graph and recommendations on Spark.

Every public function takes and returns DataFrames (or Columns); none of them
keeps a session in a global.
"""
