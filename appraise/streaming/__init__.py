"""appraise.streaming"""
