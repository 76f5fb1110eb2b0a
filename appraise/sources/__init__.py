"""appraise.sources"""
